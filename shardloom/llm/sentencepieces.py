"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

A space is put before a text, which is then cut between any two characters that are neighbours in no
piece of the vocabulary: no merge can span such a place.  Each chunk's characters are merged by an
agenda: the best-scored pair of neighbours first, the leftmost on ties.  A candidate merge is skipped for good
when the keyed hash of (seed, document's key, number of the chunk in the document, place, merged piece) falls
below ``dropout``, so every occurrence of a word draws anew, and every run with one seed gives the same ids.
Characters outside the vocabulary, and a literal U+2581 (which stands for the space inside pieces), become byte
pieces, so every segmentation decodes to the very text.

Occurrences share their work, not their draws: each distinct chunk of a slice is merged once without skips
(``Chunks``), and every occurrence draws for the candidates on that course.  One that skips none of them has the
chunk's ids; every other one runs its own agenda, many side by side as arrays of symbols.  The few long chunks go
through a heap one by one (``merge_chunk``, which is also the plain definition).

Defined results: a null text is the empty text, which has no pieces; a null id is a key like any
other; repeated rows get equal ids; ties in score go to the left; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_large, slices

SPACE = "▁"
SLICE = 6 << 20
#: chunks whose symbols are kept side by side while they are merged in step
KEPT = 1 << 14
OCCURRENCES = 1 << 16  # of a block
WIDTHS = (*range(1, 13), 16, 24, 48)  # symbols of a chunk, padded to one of these
LONGEST = WIDTHS[-1]  # characters of a chunk that is merged beside others
ROWS = 64  # a power of two over LONGEST
FAR = np.int32((1 << 31) - 1)
GONE = np.int32(-1 << 31)
_A, _B, _C = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9
_FULL = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(_A)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(_B)
        return x ^ (x >> np.uint64(31))


class Pieces:
    """Vocabulary of a SentencePiece BPE model: merges as a hashed pair table, bytes of every piece."""

    def __init__(self, path: str):
        import sentencepiece
        self.pairs: dict[int, int] = {}
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        self.byte_id = np.full(256, -1, np.int64)
        self.id: dict[str, int] = {}
        raw: list[bytes] = []
        for i, name in enumerate(names):
            if sp.is_byte(i):
                self.byte_id[int(name[3:5], 16)] = i
                raw.append(bytes([int(name[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i):
                raw.append(b"")
            else:
                self.id[name] = i
                raw.append(name.replace(SPACE, " ").encode())
        if (self.byte_id < 0).any():
            raise ValueError("the model has no byte pieces")
        self.size = n
        # the order of merges: best score first (equal scores share a rank)
        score = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.searchsorted(np.sort(np.unique(-score)), -score).astype(np.int32)
        # the piece of a rank, or -1 where several share it
        count = np.bincount(self.rank)
        self.piece_of_rank = np.full(len(count), -1, np.int32)
        self.piece_of_rank[self.rank] = np.arange(n)
        self.piece_of_rank[count > 1] = -1
        pairs = [(self.id[p[:k]], self.id[p[k:]], i) for p, i in self.id.items() for k in range(1, len(p))
                 if p[:k] in self.id and p[k:] in self.id]
        keys = np.array([a * n + b for a, b, _ in pairs] or [-1], np.int64)
        order = np.argsort(keys)
        self.keys, self.merged = keys[order], np.array([i for *_, i in pairs] or [-1], np.int32)[order]
        # pair -> place in keys, by open addressing with few probes
        self.bits = max(4, int(2 * len(keys)).bit_length() + 1)
        self.slots = np.full(1 << self.bits, -1, np.int64)
        left, self.probes = np.arange(len(keys)), 0
        while len(left):
            at = self._slot(self.keys[left], self.probes)
            free = self.slots[at] < 0
            first = np.zeros(len(left), bool)
            first[np.unique(at, return_index=True)[1]] = True
            self.slots[at[free & first]] = left[free & first]
            left = left[~(free & first)]
            self.probes += 1
        # characters of pieces, numbered from 1; the pairs of them that some piece holds side by side
        spelt = [p.replace(SPACE, " ") for p in self.id]
        letters = sorted({c for p in spelt for c in p})
        self.letter = np.zeros(0x110000, np.int32)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.letter_id = np.full(len(letters) + 1, -1, np.int32)
        for p, i in zip(spelt, self.id.values(), strict=True):
            if len(p) == 1:
                self.letter_id[self.letter[ord(p)]] = i
        self.n_letters = len(letters) + 1
        beside = np.array(sorted({(int(self.letter[ord(a)]), int(self.letter[ord(b)])) for p in spelt for a, b in zip(p, p[1:])}
                                 or [(0, 0)]), np.int64)
        at = beside[:, 0] * self.n_letters + beside[:, 1]
        self.beside = np.zeros(self.n_letters * self.n_letters // 8 + 1, np.uint8)
        np.bitwise_or.at(self.beside, at >> 3, (1 << (at & 7)).astype(np.uint8))
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        return ((_mix(keys.astype(np.uint64)) >> np.uint64(64 - self.bits)).astype(np.int64) + probe) & ((1 << self.bits) - 1)

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Id of the piece that neighbours a and b merge into, or -1."""
        keys = np.where((a < 0) | (b < 0), -2, a.astype(np.int64) * self.size + b)
        out = np.full(keys.shape, -1, np.int32)
        open_, probe = np.flatnonzero(keys >= 0), 0
        while len(open_) and probe < self.probes:
            at = self.slots[self._slot(keys[open_], probe)]
            hit = (at >= 0) & (self.keys[np.maximum(at, 0)] == keys[open_])
            out[open_[hit]] = self.merged[at[hit]]
            open_ = open_[~hit & (at >= 0)]
            probe += 1
        return out

    def pair_of(self, a: int, b: int) -> int:
        """``pair`` of two symbols, remembered."""
        if a < 0 or b < 0:
            return -1
        m = self.pairs.get(a * self.size + b)
        if m is None:
            if len(self.pairs) >= 1 << 20:
                self.pairs.clear()
            m = self.pairs[a * self.size + b] = int(self.pair(np.array([a]), np.array([b]))[0])
        return m

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the piece that neighbours merge into, ``FAR`` where there is none."""
        m = self.pair(a, b)
        return np.where(m >= 0, self.rank[m], FAR)

    def of_chars(self, cp: np.ndarray) -> np.ndarray:
        return self.letter_id[self.letter[cp]]

    def joined(self, cp: np.ndarray) -> np.ndarray:
        """For each character but the first, whether some piece holds it after the one before."""
        at = self.letter[cp].astype(np.int64)
        at = at[:-1] * self.n_letters + at[1:]
        return (self.beside[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


class Chunks:
    """Distinct short chunks, by width: the symbols and candidates that each starts from, and its course when no
    candidate is skipped, as ``place * _A + piece * _B`` of every merge, and the ids this ends with.

    Chunks lie side by side, a column each and a row for every character; a merge leaves its symbol in the left
    row, so a row is the place of its symbol.  A symbol is a piece, -1 - c for a character c without one, or
    ``GONE``; a candidate is its rank and its row in one number, ``FAR`` where there is none.  The row behind the
    last is the neighbour of the first and last symbols, and merges with nothing."""

    def __init__(self, vocabulary: Pieces, words: list[str]):
        self.vocabulary = vocabulary
        length = np.fromiter(map(len, words), np.int64, len(words))
        self.kind = np.where(length <= LONGEST, np.searchsorted(WIDTHS, length), -1)
        self.column = np.zeros(len(words), np.int64)
        self.steps, self.size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        self.first: dict[int, tuple[np.ndarray, ...]] = {}
        chunks, course, ids = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for w in np.unique(self.kind[self.kind >= 0]).tolist():
            some = np.flatnonzero(self.kind == w)
            self.column[some] = np.arange(len(some))
            self.first[w] = self._first([words[i] for i in some.tolist()], length[some], WIDTHS[w])
            for i in range(0, len(some), KEPT):
                part = some[i:i + KEPT]
                out, self.size[part], passed = self.merge(w, self.column[part], None, 0)
                lane = np.concatenate([x for x, _ in passed] or chunks[:1])
                order = np.argsort(lane, kind="stable")
                course.append(np.concatenate([x for _, x in passed] or course[:1])[order])
                self.steps[part] = np.bincount(lane, minlength=len(part))
                ids.append(out)
                chunks.append(part)
        at = np.concatenate(chunks)
        self.course, self.ids = np.concatenate(course), np.concatenate(ids)
        self.course_at, self.ids_at = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        self.course_at[at] = np.cumsum(self.steps[at]) - self.steps[at]
        self.ids_at[at] = np.cumsum(self.size[at]) - self.size[at]

    def _first(self, words: list[str], length: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
        """(symbols, candidates, rows after and rows before) of chunks of at most ``width`` characters."""
        cp = np.frombuffer("".join([x.ljust(width) for x in words]).encode("utf-32-le", "surrogatepass"), "<u4")
        cp = np.ascontiguousarray(cp.astype(np.int32).reshape(-1, width).T)
        row = np.arange(width, dtype=np.int32)[:, None]
        ids, order = (np.full((width + 1, len(words)), x, np.int32) for x in (GONE, FAR))
        after, before = (np.full((width + 1, len(words)), width, np.int8) for _ in range(2))
        piece = self.vocabulary.of_chars(cp)
        ids[:-1] = np.where(row >= length, GONE, np.where(piece < 0, -1 - cp, piece))
        order[:-2] = self._candidate(ids[:-2], ids[1:-1], row[:-1])
        after[:-1] = np.where(row + 1 < length, row + 1, width)
        before[1:-1] = row[:-1]
        return ids, order, after, before

    def _candidate(self, a: np.ndarray, b: np.ndarray, row: np.ndarray) -> np.ndarray:
        rank = self.vocabulary.ranks(a.ravel(), b.ravel()).reshape(a.shape)
        return np.where(rank < FAR, rank * ROWS + row, FAR)

    def merge(self, w: int, column: np.ndarray, keys: np.ndarray | None, limit: int) -> tuple:
        """(ids of the chunks in these columns, number of each one's, merges made), all chunks in step; without
        ``keys`` nothing is skipped, and only then the merges are noted, as (chunks, ``course`` of each) a step."""
        vocabulary, n, width = self.vocabulary, len(column), WIDTHS[w]
        symbols, order, after, before = (np.ascontiguousarray(x[:, column]) for x in self.first[w])
        ids, candidate, after, before = (x.reshape(-1) for x in (symbols, order, after, before))
        passed = []
        while True:
            best = order.min(axis=0)  # the leftmost of the least ranks
            lane = np.flatnonzero(best < FAR)
            if not len(lane):
                break
            best = best[lane]
            row = (best & (ROWS - 1)).astype(np.int64)
            at, merged = row * n + lane, vocabulary.piece_of_rank[best // ROWS]
            shared = np.flatnonzero(merged < 0)  # a score that several pieces have
            if len(shared):
                right = after[at[shared]].astype(np.int64) * n + lane[shared]
                merged[shared] = vocabulary.pair(ids[at[shared]], ids[right])
            if keys is None:
                with np.errstate(over="ignore"):
                    passed.append((lane, row.astype(np.uint64) * np.uint64(_A) + merged.astype(np.uint64) * np.uint64(_B)))
            else:
                skip = _skips(keys[lane], row, merged, limit)
                candidate[at[skip]] = FAR
                lane, row, at, merged = (x[~skip] for x in (lane, row, at, merged))
            gone = after[at].astype(np.int64) * n + lane
            behind, ahead = after[gone], before[at]
            ids[at], ids[gone], candidate[gone] = merged, GONE, FAR
            after[at], next_ = behind, behind.astype(np.int64) * n + lane
            before[next_] = row
            last = ahead.astype(np.int64) * n + lane  # the merged symbol's pairs with its neighbours
            candidate[np.concatenate((at, last))] = self._candidate(
                np.concatenate((merged, ids[last])), np.concatenate((ids[next_], merged)),
                np.concatenate((row, ahead)).astype(np.int32))
        symbols = symbols[:-1].T
        live = symbols > GONE
        flat, count = symbols[live], live.sum(axis=1)
        if (flat < 0).any():
            parts = [[x] if x >= 0 else [int(vocabulary.byte_id[b]) for b in chr(-1 - x).encode("utf-8", "surrogatepass")]
                     for x in flat.tolist()]
            owner = np.repeat(np.arange(n), count)
            count = np.bincount(owner, weights=[len(x) for x in parts], minlength=n).astype(np.int64)
            flat = np.array([x for part in parts for x in part], np.int64)
        return flat, count, passed

    def strays(self, codes: np.ndarray, keys: np.ndarray, limit: int) -> np.ndarray:
        """The occurrences that skip some candidate of their chunk's course."""
        if not limit:
            return np.zeros(0, np.int64)
        steps = self.steps[codes]
        ends = np.cumsum(steps)
        take = np.arange(ends[-1]) + np.repeat(self.course_at[codes] - ends + steps, steps)
        with np.errstate(over="ignore"):
            skip = _mix(np.repeat(keys, steps) + self.course[take]) >> np.uint64(11) < np.uint64(limit)
        return np.unique(np.searchsorted(ends, np.flatnonzero(skip), side="right"))


@lru_cache(maxsize=2)
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _skips(key: np.ndarray, start: np.ndarray, merged: np.ndarray, limit: int) -> np.ndarray:
    """Whether the candidate merge at ``start`` into ``merged`` is dropped."""
    if not limit:
        return np.zeros(len(key), bool)
    with np.errstate(over="ignore"):
        h = _mix(key + start.astype(np.uint64) * np.uint64(_A) + merged.astype(np.uint64) * np.uint64(_B))
    return (h >> np.uint64(11)).astype(np.int64) < limit


def _skips_one(key: int, start: int, merged: int, limit: int) -> bool:
    x = (key + start * _A + merged * _B) & _FULL
    x = ((x ^ (x >> 30)) * _A) & _FULL
    x = ((x ^ (x >> 27)) * _B) & _FULL
    return (x ^ (x >> 31)) >> 11 < limit


def merge_chunk(vocabulary: Pieces, chunk: str, key: int, dropout: float) -> list[int]:
    """The ids of one chunk's occurrence, by the agenda as defined."""
    limit = int(dropout * (1 << 53))
    ids = vocabulary.of_chars(np.array([ord(c) for c in chunk], np.int64)).tolist()
    after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
    rank, agenda = vocabulary.rank, []

    def offer(i: int, j: int) -> None:
        if i < 0 or j >= len(ids):
            return
        m = vocabulary.pair_of(ids[i], ids[j])
        if m >= 0:
            heapq.heappush(agenda, (int(rank[m]), i, m, ids[j]))

    for i in range(len(ids) - 1):
        offer(i, i + 1)
    gone = [False] * len(ids)
    while agenda:
        _, i, m, right = heapq.heappop(agenda)
        j = after[i]
        if gone[i] or j >= len(ids) or ids[j] != right or vocabulary.pair_of(ids[i], ids[j]) != m:
            continue  # one of the two has been merged since
        if limit and _skips_one(key, i, m, limit):
            continue
        ids[i], gone[j] = m, True
        after[i] = after[j]
        if after[j] < len(ids):
            before[after[j]] = i
        offer(before[i], i)
        offer(i, after[i])
    out = []
    for i, x in enumerate(ids):
        if not gone[i]:
            out += [x] if x >= 0 else [int(vocabulary.byte_id[b]) for b in chunk[i].encode("utf-8", "surrogatepass")]
    return out


def merge_all(vocabulary: Pieces, words: list[str], codes: np.ndarray, keys: np.ndarray, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the occurrences ``words[codes]`` one after the other, number of each one's)."""
    limit, chunks = int(dropout * (1 << 53)), Chunks(vocabulary, words)
    begin, count = chunks.ids_at[codes], chunks.size[codes]
    tables, end = [chunks.ids.astype(np.uint32)], len(chunks.ids)
    kind = chunks.kind[codes].astype(np.int8)
    strays = [np.zeros(0, np.int64)]
    for i in range(0, len(codes), OCCURRENCES):
        strays.append(i + chunks.strays(codes[i:i + OCCURRENCES], keys[i:i + OCCURRENCES], limit))
    stray = np.concatenate(strays)
    for w in np.unique(kind[stray]).tolist():
        some = stray[kind[stray] == w]
        for i in range(0, len(some), KEPT):
            part = some[i:i + KEPT]
            ids, count[part], _ = chunks.merge(w, chunks.column[codes[part]], keys[part], limit)
            begin[part] = end + np.cumsum(count[part]) - count[part]
            tables.append(ids.astype(np.uint32))
            end += len(ids)
    for i in np.flatnonzero(kind < 0).tolist():
        tables.append(np.array(merge_chunk(vocabulary, words[codes[i]], int(keys[i]), dropout), np.uint32))
        begin[i], count[i] = end, len(tables[-1])
        end += len(tables[-1])
    table, out = np.concatenate(tables), [np.zeros(0, np.uint32)]
    for i in range(0, len(codes), OCCURRENCES):
        size = count[i:i + OCCURRENCES]
        ends = np.cumsum(size)
        out.append(table[np.arange(ends[-1]) + np.repeat(begin[i:i + OCCURRENCES] - ends + size, size)])
    return np.concatenate(out), count


def encode_texts(vocabulary: Pieces, texts: pa.Array, keys: np.ndarray, seed: int, dropout: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, start of each text's with the total appended); ``keys``: one for each document."""
    filled = pc.not_equal(texts, "")
    spaced = pc.if_else(filled, pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), texts,
                                                            pa.scalar("", pa.large_string())), "")
    spaced = pa.concat_arrays([spaced])  # offsets from 0
    where = np.frombuffer(spaced.buffers()[1], np.int64, len(spaced) + 1, 8 * spaced.offset)
    raw = spaced.buffers()[2].slice(int(where[0]), int(where[-1] - where[0])) if spaced.buffers()[2] else pa.py_buffer(b"")
    where = where - where[0]
    cp = np.frombuffer(raw.to_pybytes().decode().encode("utf-32-le"), "<u4")
    # place of each character in the bytes; chunks start at texts and between strangers
    place = np.cumsum(1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000), dtype=np.int64)
    place = np.concatenate(([0], place))
    first = np.zeros(len(cp), bool)
    if len(cp):
        first[1:] = ~vocabulary.joined(cp)
        first[np.searchsorted(place, where[:-1][np.diff(where) > 0])] = True
    cuts = place[:-1][first]
    flat = pa.LargeStringArray.from_buffers(len(cuts), pa.py_buffer(np.concatenate((cuts, place[-1:])).tobytes()), raw)
    starts = np.searchsorted(cuts, where)
    counts = np.diff(starts)
    coded = pc.dictionary_encode(flat)
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    number = np.arange(len(codes)) - np.repeat(starts[:-1], counts)
    with np.errstate(over="ignore"):
        draw = _mix(np.repeat(keys.view(np.uint64), counts) + number.astype(np.uint64) * np.uint64(_C) + np.uint64(seed & _FULL))
    ids, sizes = merge_all(vocabulary, coded.dictionary.to_pylist(), codes, draw, dropout)
    return ids, np.concatenate(([0], np.cumsum(sizes)))[starts]


def decode_ids(vocabulary: Pieces, ids: np.ndarray) -> bytes:
    """The text (UTF-8) of a document's ids: the pieces' bytes without the space put before the first."""
    size = vocabulary.raw_size[ids]
    ends = np.cumsum(size)
    if not len(ends):
        return b""
    take = np.arange(ends[-1]) + np.repeat(vocabulary.raw_start[ids] - (ends - size), size)
    return vocabulary.raw[take].tobytes()[1:]


def encode_column(path: str, text: str | Column, key: Column, seed: int = 1, dropout: float = 0.1) -> Column:
    """ids of a text column as little-endian unsigned 32-bit integers; ``key``: a long for each document."""
    def run(texts: pa.Array, keys: pa.Array) -> pa.Array:
        texts, out = as_large(texts), []
        keys = pc.fill_null(keys, 0).to_numpy(zero_copy_only=False).astype(np.int64)
        for a, b in slices(texts, SLICE):
            ids, at = encode_texts(pieces(path), texts[a:b], keys[a:b], seed, dropout)
            raw, at = ids.tobytes(), (4 * at).tolist()
            out += [raw[s:e] for s, e in zip(at, at[1:])]
        return pa.array(out, pa.binary())

    run.__annotations__ = {"texts": pa.Array, "keys": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "binary")(F.col(text) if isinstance(text, str) else text, key)


def decode_column(path: str, ids: str | Column) -> Column:
    def run(ids: pa.Array) -> pa.Array:
        vocabulary = pieces(path)
        return pa.array([decode_ids(vocabulary, np.frombuffer(x.as_buffer(), "<u4").astype(np.int64)).decode()
                         for x in pc.fill_null(ids, b"")], pa.string())

    run.__annotations__ = {"ids": pa.Array, "return": pa.Array}
    return F.arrow_udf(run, "string")(F.col(ids) if isinstance(ids, str) else ids)


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                     dropout: float = 0.1) -> DataFrame:
    """doc_id, text and ids of every document."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn(
        "ids", encode_column(path, "text", F.xxhash64("doc_id"), seed, dropout))
