"""Names in texts by whole runs of words; keyed upserts that read what they touch."""

import random
import re

from pyspark.sql import functions as F

from tallymark.operators import documents as D
from tallymark.streaming import ingest


def brute(texts, names):
    out = {}
    for i, t in texts:
        flat = re.sub(r"\s+", " ", t or "").strip()
        best = {}
        for name, owner in names:
            core = re.sub(r"^[\W_]+|[\W_]+$", "", re.sub(r"\s+", " ", name))
            if core and re.search(rf"(?<![^\W_]){re.escape(core)}(?![^\W_])", flat):
                best.setdefault(len(re.sub(r"\s+", " ", name).strip()), set()).add(owner)
        if best:
            owners = best[max(best)]
            out[i] = (min(owners), len(owners) > 1)
    return out


def test_longest_names_equal_brute_force(spark):
    r = random.Random(4)
    words = ["Alpha", "Beta", "Gamma", "Ltd", "Ärzte", "2000", "co"]
    between = [" ", ", ", "-", "  ", " & "]
    phrase = lambda n: "".join(r.choice(words) + r.choice(between) for _ in range(n))
    names = [(phrase(r.randrange(1, 4)).strip(" ,&-"), f"o{r.randrange(9)}") for _ in range(60)] + [('"Alpha" Ltd.', "q"), ("--", "none"), ("", "none")]
    texts = [(i, phrase(r.randrange(0, 25))) for i in range(150)] + [(900, None), (901, ""), (902, "...Alpha" + " x" * 5000), (903, "Alphabet")]
    got = D.longest_match(spark.createDataFrame(texts, "doc int, text string"), spark.createDataFrame(names, "name string, owner string"), "doc", "owner")
    assert {x.doc: (x.owner, x.ambiguous) for x in got.collect()} == brute(texts, names)
    assert D.longest_match(spark.createDataFrame(texts, "doc int, text string"), spark.createDataFrame([], "name string, owner string"), "doc", "owner").collect() == []


def test_many_names_with_one_first_word(spark):
    names = spark.range(100_000).select(F.concat(F.lit("Alpha number "), F.col("id")).alias("name"), F.col("id").cast("string").alias("owner"))
    texts = spark.range(300).select("id", F.concat(F.lit("we paid Alpha number "), F.col("id") * 331, F.lit(" and Alpha again")).alias("text"))
    got = D.longest_match(texts.withColumnRenamed("id", "doc"), names, "doc", "owner").collect()
    assert {r.doc: r.owner for r in got} == {i: str(i * 331) for i in range(300)} and not any(r.ambiguous for r in got)


def test_an_upsert_reads_only_the_partitions_that_it_touches(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("source", "target", "checkpoint"))
    schema = "txn_id string, amount double"

    def add(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        query = ingest.upsert_ledger(ingest.stream_parquet(spark, source, spark.createDataFrame([], schema).schema), target, checkpoint, 16)
        query.awaitTermination()
        assert query.exception() is None

    first = [(f"T{i}", float(i)) for i in range(200)] + [(None, 0.0)]
    add(first + first[:20])
    whole = {(r.txn_id, r.amount) for r in spark.read.parquet(target).collect()}
    assert whole == set(first) and spark.read.parquet(target).count() == 201
    mine = spark.createDataFrame([("T7", 0.0)], schema).select(F.pmod(F.xxhash64("txn_id"), F.lit(16)).alias("b")).first().b
    # Whatever stands in other partitions is not even opened.
    others = [p for p in (tmp_path / "target").glob("bucket=*/*.parquet") if p.parent.name != f"bucket={mine}"]
    kept = {p: p.read_bytes() for p in others}
    for p in others:
        p.with_name(f".{p.name}.crc").unlink(missing_ok=True)
        p.write_bytes(b"broken")
    add([("T7", -1.0)])
    for p, body in kept.items():
        p.write_bytes(body)
    add([("T7", -2.0), ("U1", 5.0), (None, 9.0)])
    after = {(r.txn_id, r.amount) for r in spark.read.parquet(target).collect()}
    assert after == whole | {("U1", 5.0)}
