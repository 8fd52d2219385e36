"""Passes over tiles in the near-duplicate join (2, pipeline) and the release of what they shuffled."""

import random

from shardloom.llm import jaccard
from shardloom.llm.common import release
from test_pairs_lines import _check_groups, _family


def test_tiles_worked_on_in_passes_lose_no_link(spark, monkeypatch, tmp_path):
    """Every pass shuffles a part of the tiles and releases it before the next."""
    rnd = random.Random(21)
    texts = [t for k in range(6) for t in _family(rnd, 60, 8, 5)] + [None, "", "a b"]
    released, found = [], []
    monkeypatch.setattr(jaccard, "PASS_BYTES", 1)
    monkeypatch.setattr(jaccard.fs, "stored", lambda *a: 6_000)
    monkeypatch.setattr(jaccard, "release", released.append)
    monkeypatch.setattr(jaccard, "scratch_path", lambda *a: str(tmp_path))
    monkeypatch.setattr(jaccard, "_across", lambda *a, f=jaccard._across: found.append(a) or f(*a))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check_groups(jaccard.near_duplicates(df), texts, 5, 80, 100)
    assert len(found) > 2 and len(released) > len(found) + 2
    tiles = spark.read.parquet(str(tmp_path / "stars"))
    assert tiles.groupBy("tile").agg({"centre": "min"}).count() == tiles.select("tile", "centre").distinct().count()


def test_one_pass_is_enough_for_little(spark, monkeypatch):
    found = []
    monkeypatch.setattr(jaccard, "_across", lambda *a, f=jaccard._across: found.append(a) or f(*a))
    texts = _family(random.Random(4), 40, 5, 3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    _check_groups(jaccard.near_duplicates(df), texts, 5, 80, 100)
    assert len(found) <= 2


def test_release_waits_until_the_jvm_knows_what_python_dropped(spark):
    dropped = spark.sparkContext._gateway._gateway_client.finalizer_deque
    frames = [spark.range(i) for i in range(200)]
    del frames
    release(spark)
    assert not dropped
