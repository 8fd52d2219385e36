"""Registered source/sink queries (S1-S11).  Each writes what it needs from
the driver's tables into a fresh folder under the shared checkpoint folder
and reads it back, so the check covers the round trip."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import splits as B
from ..operators import text as T
from ..session import scratch_path
from ..sources import cursor as C
from ..sources import readers as R
from ..sources import shards as S
from ..sources import writers as WR
from . import fixtures as FX
from .queries_text import _DUCK_VOCAB, SEQ_LEN, VOCAB_SIZE, duck_encoded
from .registry import register, table


@register("read_lines_urls", sql="""
select url as path from pages
""")
def read_lines_urls(spark, sf):
    """A text file of addresses read back one row per line."""
    p = scratch_path(spark, "lines")
    table(spark, sf, "pages").select("url").write.mode("overwrite").text(p)
    return R.read_lines(spark, p)


_DUCK_HASH_TEST = ("case when ('0x' || substr(md5(cast({k} as varchar)), 1, 15))::BIGINT < (1::BIGINT << 60) // 5 "
                   "then 'test' else 'train' end")


@register("read_parquet_split_dirs", sql=f"""
select {_DUCK_HASH_TEST.format(k='o_orderkey')} as split, count(*) as n_rows,
       round(sum(o_totalprice), 2) as total
from orders group by 1
""")
def read_parquet_split_dirs(spark, sf):
    """Splits written side by side as parquet, read as one dataset."""
    p = scratch_path(spark, "splits")
    o = B.train_test_split(table(spark, sf, "orders"), 0.2, "o_orderkey", "hash")
    WR.write_parquet(o, p, partition_by=["split"])
    back = R.read_parquet(spark, p)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("split_tables_roundtrip", sql=f"""
select lang, count(*) as n_docs from documents
where {_DUCK_HASH_TEST.format(k='doc_id')} = 'train' group by lang
""")
def split_tables_roundtrip(spark, sf):
    """One catalog table per split, then the train table read by name."""
    prefix = f"docs_{uuid.uuid4().hex[:8]}"
    d = B.train_test_split(table(spark, sf, "documents").select("doc_id", "lang"), 0.2, "doc_id", "hash")
    names = WR.write_splits(d, "split", prefix, scratch_path(spark, "tables"), splits=["train", "test"])
    t = R.read_table(spark, f"{prefix}_train")
    out = t.groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs")).checkpoint()
    for n in names:  # external tables: their files stay until the folder goes
        spark.sql(f"DROP TABLE {n}")
    return out


INFO_KEY = "dataset--info"


@register("read_class_names", sql="""
select cast(row_number() over (order by r_regionkey) - 1 as integer) as category_id, r_name as category_name
from region
""")
def read_class_names(spark, sf):
    """A JSON info document (built from ``region``) read at a fixed field
    path, names numbered from 0."""
    p = scratch_path(spark, "info")
    names = table(spark, sf, "region").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r_regionkey", "r_name"))),
                    lambda r: r["r_name"]).alias("names"))
    category = F.struct(F.col("names").alias("names"))
    feature = F.struct(category.alias("category"))
    objects = F.struct(feature.alias("feature"))
    features = F.struct(objects.alias("objects"))
    info = F.struct(F.struct(features.alias("features")).alias(INFO_KEY))
    doc = names.select(F.to_json(info).alias("value"))
    doc.coalesce(1).write.mode("overwrite").text(p)
    return R.read_classes(spark, p, [INFO_KEY, "features", "objects", "feature", "category", "names"])


SHARD_COLUMNS = {"label": "int32", "input_ids": "ndarray:int32", "token_type_ids": "ndarray:int32",
                 "attention_mask": "ndarray:int32"}
SHARD_PARTS = 10
SHARD_LIMIT = 8192
SHARD_SEQ = SEQ_LEN


def _encoded_sentences(spark, sf):
    s = FX.sentences(spark, sf)
    vocab = T.build_vocab(table(spark, sf, "documents"), "text", VOCAB_SIZE)
    # an export reads its rows more than once: encoded once
    return T.encode(s, vocab, "idx", "sentence", SHARD_SEQ, keep=["label"]).checkpoint()


def _duck_rolled(rows: str, parts: int, limit: int) -> str:
    """CTEs from ``rows`` (idx, row_bytes, digest, ...) to ``sh`` (with part and
    shard by the sequential rule) and ``man`` (manifest without start)."""
    words = " || ".join(f"format('{{:08x}}', (sum(('0x' || substr(p.digest, {8 * i + 1}, 8))::BIGINT) % 4294967296)::BIGINT)"
                        for i in range(5))
    return f"""{rows},
parted as (
  select *, cast(case when n // {parts} = 0 then {parts - 1}
                      else least(ri // greatest(n // {parts}, 1), {parts - 1}) end as integer) as part
  from (select *, row_number() over (order by idx) - 1 as ri, count(*) over () as n from rows) q),
ex as (
  select part, list(idx order by idx) as idxs,
         list_reduce(list(row_bytes order by idx), lambda acc, b:
           case when acc.cur > 0 and acc.cur + b > {limit}
                then {{'cur': b::BIGINT, 'sid': acc.sid + 1, 'ids': list_append(acc.ids, acc.sid + 1)}}
                else {{'cur': acc.cur + b, 'sid': acc.sid, 'ids': list_append(acc.ids, acc.sid)}} end,
           {{'cur': 0::BIGINT, 'sid': 0::BIGINT, 'ids': []::BIGINT[]}}).ids as sids
  from parted group by part),
sx as (select part, unnest(idxs) as idx, unnest(sids) as shard from ex),
sh as (select p.*, cast(x.shard as integer) as shard from parted p join sx x on p.part = x.part and p.idx = x.idx),
man as (
  select part, shard, count(*) as rows, cast(sum(row_bytes) as bigint) as bytes, {words} as hash
  from sh p group by part, shard)
"""


_DUCK_ENCODED_ROWS = f"""
with {_DUCK_VOCAB},
{FX.DUCK["fx_sentences"]},
{duck_encoded("fx_sentences", "idx", "sentence", SHARD_SEQ)},
rows as (
  select *, 4 + 4 * len(input_ids) + 4 * len(tt) + 4 * len(am) as row_bytes,
         sha1(concat_ws(chr(31), cast(label as varchar), array_to_string(input_ids, ','),
                        array_to_string(tt, ','), array_to_string(am, ','))) as digest
  from (select e.idx, s.label, e.input_ids,
               list_transform(range({SHARD_SEQ}), lambda x: 0) as tt,
               list_transform(range({SHARD_SEQ}), lambda x: case when x < e.n_real then 1 else 0 end) as am
        from enc e join fx_sentences s using (idx)) q)"""
_DUCK_SHARDS = _duck_rolled(_DUCK_ENCODED_ROWS, SHARD_PARTS, SHARD_LIMIT)
_DUCK_START = """
select part, shard, rows, bytes, hash,
       cast(coalesce(sum(rows) over (order by part, shard rows between unbounded preceding and 1 preceding), 0)
            as bigint) as start
from man
"""


@register("export_shards_manifest", sql=_DUCK_SHARDS + _DUCK_START)
def export_shards_manifest(spark, sf):
    """Encoded sentences exported as 10 parts of zstd shards rolled
    at 8,192 bytes, with the merged manifest (rows, bytes, start, hash)."""
    p = scratch_path(spark, "shards")
    return S.export_shards(_encoded_sentences(spark, sf), p, SHARD_COLUMNS, "idx",
                           parts=SHARD_PARTS, size_limit=SHARD_LIMIT)


TEXT_COLUMNS = {"sentence": "str", "label": "int", "idx": "int"}
TEXT_LIMIT = 1 << 16


@register("export_text_shards_manifest", sql=_duck_rolled(f"""
with {FX.DUCK["fx_sentences"]},
rows as (select idx, octet_length(encode(sentence)) + 16 as row_bytes,
                sha1(concat_ws(chr(31), sentence, cast(label as varchar), cast(idx as varchar))) as digest
         from fx_sentences)""", 4, TEXT_LIMIT) + _DUCK_START)
def export_text_shards_manifest(spark, sf):
    """S7 on raw text and mixed types: sentence, label and number, rolled at
    64 KiB."""
    p = scratch_path(spark, "text-shards")
    return S.export_shards(FX.sentences(spark, sf), p, TEXT_COLUMNS, "idx", parts=4, size_limit=TEXT_LIMIT)


@register("verify_shards", sql=_DUCK_SHARDS + """
select part, shard, rows, true as rows_ok, true as hash_ok from man
union all select -1, -1, count(*), true, true from rows
""")
def verify_shards(spark, sf):
    """Shards read back and checked shard by shard against the manifest,
    and all together against the source frame."""
    p = scratch_path(spark, "shards")
    src = _encoded_sentences(spark, sf)
    S.export_shards(src, p, SHARD_COLUMNS, "idx", parts=SHARD_PARTS, size_limit=SHARD_LIMIT)
    return S.verify_export(spark, p, SHARD_COLUMNS, src)


@register("list_shard_files", sql=_DUCK_SHARDS + """
select part, shard, 1 as n_files, true as has_bytes from man
""")
def list_shard_files(spark, sf):
    """The ``*.parquet`` files of an export, per shard folder."""
    p = scratch_path(spark, "shards")
    S.export_shards(_encoded_sentences(spark, sf), p, SHARD_COLUMNS, "idx", parts=SHARD_PARTS,
                    size_limit=SHARD_LIMIT)
    files = R.list_artifacts(spark, p, "*.parquet")
    return (files.select(F.regexp_extract("path", r"/part=(\d+)/", 1).cast("int").alias("part"),
                         F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("int").alias("shard"), "bytes")
            .groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n_files"), (F.min("bytes") > 0).alias("has_bytes")))


@register("coco_export_sections", sql=FX.duck_with("fx_objects", "fx_classes") + """
select 'images' as section, image_id as id, cast(null as bigint) as image_id, cast(null as bigint) as category_id,
       cast(null as bigint) as iscrowd, cast(null as double) as area,
       width || 'x' || height || ' ' || image_id || '.png' as detail
from fx_images
union all
select 'annotations', row_number() over (order by image_id, bbox_id), image_id, category, 0, round(w * h, 6),
       array_to_string([round(x, 3), round(y, 3), round(w, 3), round(h, 3)], ' ')
from fx_objects
union all
select 'categories', category_id, null, null, null, null, category_name || ' none' from fx_classes
""")
def coco_export_sections(spark, sf):
    """COCO sections written as JSON-lines folders and read back, every
    row and column of them."""
    p = scratch_path(spark, "coco")
    frames = WR.coco_frames(FX.images(spark, sf), FX.objects(spark, sf), FX.classes(spark, sf))
    WR.write_coco(frames, p)
    img = spark.read.json(f"{p}/images")
    ann = spark.read.json(f"{p}/annotations")
    cat = spark.read.json(f"{p}/categories")
    none = {k: F.lit(None).cast(t).alias(k) for k, t in
            (("image_id", "bigint"), ("category_id", "bigint"), ("iscrowd", "bigint"), ("area", "double"))}
    box = F.array_join(F.transform("bbox", lambda x: F.round(x, 3).cast("string")), " ")
    return (img.select(F.lit("images").alias("section"), "id", *none.values(),
                       F.concat(F.col("width").cast("string"), F.lit("x"), F.col("height").cast("string"), F.lit(" "),
                                "file_name").alias("detail"))
            .unionByName(ann.select(F.lit("annotations").alias("section"), "id", "image_id", "category_id", "iscrowd",
                                    F.round("area", 6).alias("area"), box.alias("detail")))
            .unionByName(cat.select(F.lit("categories").alias("section"), "id", *none.values(),
                                    F.concat("name", F.lit(" "), "supercategory").alias("detail"))))


@register("sample_shards_head", sql=_DUCK_SHARDS + """
select part, shard, idx, cast(label as integer) as label,
       cast(len(input_ids) as integer) as input_ids_len, 'array<int>' as input_ids_type,
       cast(len(tt) as integer) as token_type_ids_len, 'array<int>' as token_type_ids_type,
       cast(len(am) as integer) as attention_mask_len, 'array<int>' as attention_mask_type
from sh order by part, shard, idx limit 5
""")
def sample_shards_head(spark, sf):
    """S9 display: the first five samples read back in shard order, with
    each array column's length and element type."""
    p = scratch_path(spark, "shards")
    S.export_shards(_encoded_sentences(spark, sf), p, SHARD_COLUMNS, "idx", parts=SHARD_PARTS,
                    size_limit=SHARD_LIMIT)
    return S.sample_shards(spark, p, SHARD_COLUMNS, "idx", 5)


@register("export_shards_exact_manifest", sql=_duck_rolled(_DUCK_ENCODED_ROWS, 3, 5 * SHARD_LIMIT) + _DUCK_START)
def export_shards_exact_manifest(spark, sf):
    """S7 with fewer, larger shards: three parts rolled at 40,960 bytes."""
    p = scratch_path(spark, "shards-exact")
    return S.export_shards(_encoded_sentences(spark, sf), p, SHARD_COLUMNS, "idx", parts=3, size_limit=5 * SHARD_LIMIT)


@register("read_shard_positions", sql=_duck_rolled(f"""
with {FX.DUCK["fx_sentences"]},
rows as (select idx, sentence, label, octet_length(encode(sentence)) + 16 as row_bytes, '' as digest
         from fx_sentences)""", 4, TEXT_LIMIT).replace("man as (", "unused as (") + """
, man as (select part, shard, count(*) as n,
                 sum(count(*)) over (order by part, shard) - count(*) as start from sh group by part, shard),
asked as (select cast(o_orderkey % (select count(*) from sh) as bigint) as position from orders)
select a.position, s.part, s.shard, cast(a.position - m.start as bigint) as "offset",
       s.idx, s.sentence, s.label
from asked a
join (select *, row_number() over (order by part, shard, idx) - 1 as pos from sh) s on s.pos = a.position
join man m on m.part = s.part and m.shard = s.shard
""")
def read_shard_positions(spark, sf):
    """Samples read by position, one for every order, whose key picks it."""
    p = scratch_path(spark, "text-shards")
    man = S.export_shards(FX.sentences(spark, sf), p, TEXT_COLUMNS, "idx", parts=4, size_limit=TEXT_LIMIT)
    n = man.agg(F.sum("rows")).first()[0]
    asked = table(spark, sf, "orders").select((F.col("o_orderkey") % F.lit(n)).alias("position"))
    return S.read_positions(spark, p, asked)


@register("read_resumed_workers", sql=_duck_rolled(f"""
with {FX.DUCK["fx_sentences"]},
rows as (select idx, sentence, label, octet_length(encode(sentence)) + 16 as row_bytes, '' as digest
         from fx_sentences)""", 4, TEXT_LIMIT).replace("man as (", "unused as (") + """
, man as (select part, shard, count(*) as n from sh group by part, shard),
ord as (select part, shard, sum(n) over (order by md5('7:1:' || part || ':' || shard), part, shard) - n as start from man),
stream as (
  select s.part, s.shard, s.idx, s.label, o.start + row_number() over w - 1 as pos, row_number() over w - 1 as off
  from sh s join ord o on o.part = s.part and o.shard = s.shard window w as (partition by s.part, s.shard order by s.idx)),
runs as (select *, case when pos < 144 then 3 else 5 end as workers, pos - case when pos < 144 then 0 else 144 end as nth from stream)
select workers, cast((nth // 16) % workers as int) as worker, cast(nth // 16 as bigint) as batch, cast(nth % 16 as bigint) as place,
       part, shard, cast(off as bigint) as "offset", idx, label
from runs
""")
def read_resumed_workers(spark, sf):
    """Three workers read three rounds of batches of 16, then five read the rest of the epoch."""
    p = scratch_path(spark, "text-shards")
    man = S.export_shards(FX.sentences(spark, sf), p, TEXT_COLUMNS, "idx", parts=4, size_limit=TEXT_LIMIT)
    total = man.agg(F.sum("rows")).first()[0]
    start = C.Cursor(epoch=1)
    rest = C.advance(start, 3, 3, 16, total)
    out = C.read_batches(spark, p, start, 3, 16, rounds=3, seed=7, columns=["idx", "label"]).withColumn("workers", F.lit(3))
    if rest.epoch == start.epoch:
        out = out.unionByName(C.read_batches(spark, p, rest, 5, 16, seed=7, columns=["idx", "label"]).withColumn("workers", F.lit(5)))
    return out
