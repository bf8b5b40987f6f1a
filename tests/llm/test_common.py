import numpy as np
import pytest

from dirbook.llm.common import keyed, places, shared_base, word_hashes


def test_rows_keep_their_numbers_when_cores_come_and_go(spark, tmp_path):
    names = ("spark.sql.files.minPartitionNum", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    before = {c: spark.conf.get(c, None) for c in names}
    path = str(tmp_path / "docs")
    spark.range(20000).selectExpr("id AS doc_id", "sha2(cast(id AS string), 256) AS text").repartitionByRange(5, "doc_id").write.option("parquet.block.size", 1 << 16).parquet(path)
    try:
        spark.conf.unset(names[0])
        spark.conf.set(names[2], "1k")
        numbers = []
        for cores in (8, 2):
            spark.conf.set(names[1], str(cores))
            numbers.append({r["doc_id"]: r["rid"] for r in keyed(spark.read.parquet(path)).select("rid", "doc_id").collect()})
        assert numbers[0] == numbers[1] and len(set(numbers[0].values())) == 20000
    finally:
        for c, x in before.items():
            spark.conf.unset(c) if x is None else spark.conf.set(c, x)


def test_ids_that_are_no_numbers_count_as_null(spark):
    df = spark.createDataFrame([("a7", "x"), ("12", "y"), (None, None)], "doc_id string, text string")
    assert sorted(((r["doc_id"], r["text"]) for r in keyed(df).collect()), key=str) == [(12, "y"), (None, ""), (None, "x")]


def test_a_cluster_needs_a_shared_folder():
    class Session:
        def __init__(self, **conf):
            self.conf = conf

    with pytest.raises(ValueError):
        shared_base(Session(**{"spark.master": "spark://host:7077"}))
    assert shared_base(Session(**{"spark.master": "yarn", "spark.checkpoint.dir": "s3a://b/x/"})) == "s3a://b/x"


def test_words_are_hashed_by_content():
    texts = ["", " ", "a b", "A b\x1c \x0bq", "x" * 3_000_000 + " a " + "é" * 10, "a"]
    words = [w for t in texts for w in t.encode().split()]
    for lower in (False, True):
        hashes, counts = word_hashes([t.encode() for t in texts], lower)
        assert counts.tolist() == [len(t.encode().split()) for t in texts]
        assert len({*zip(hashes.tolist(), (w.lower() if lower else w for w in words))}) == len(set(hashes.tolist())) == len({w.lower() if lower else w for w in words})
    assert len(word_hashes([])[0]) == 0


def test_no_family_of_words_has_one_hash():
    """A word of the Thue-Morse sequence and its complement collide under any polynomial modulo a power of two."""
    for n in (16, 64, 1024, 4096):
        word = "".join("ab"[i.bit_count() % 2] for i in range(n))
        hashes, _ = word_hashes([word.encode(), word.translate(str.maketrans("ab", "ba")).encode()])
        assert len(set(hashes.tolist())) == 2
    words = [f"{i:x}" for i in range(200_000)]
    assert len(set(word_hashes([" ".join(words).encode()])[0].tolist())) == len(words)
    assert len(set(word_hashes([b"a a\0 a\0\0 " + b"a" * 8 + b" " + b"a" * 9 + b" " + b"a" * 64 + b" " + b"a" * 65])[0].tolist())) == 7


def test_places_of_sorted_keys():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64))
    assert (places(keys, keys[::-1]) == np.arange(len(keys))[::-1]).all()
    assert places(keys[:1], keys[[0, 0]]).tolist() == [0, 0] and len(places(keys, keys[:0])) == 0
