"""Exact dedup and decontamination against SQL over the same rows."""

import duckdb
import pytest
from pyspark.sql import functions as F

from graphloom.llm import decontaminate, exact_dedup
from graphloom.llm.common import stored
from graphloom.llm.queries import ORACLES, QUERIES


def rows_of(df, columns):
    return sorted(tuple(str(r[c]) for c in columns) for r in df.select(*columns).collect())


def oracle(name, **tables):
    con = duckdb.connect()
    for table, frame in tables.items():
        con.register(table, frame.toArrow())
    result = con.execute(ORACLES[name])
    columns = [c[0] for c in result.description]
    return columns, sorted(tuple(str(v) for v in r) for r in result.fetchall())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, folder, name):
    tables = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark")}
    columns, expected = oracle(name, **tables)
    assert rows_of(QUERIES[name](spark, folder), columns) == expected and expected


def expected_copies(docs):
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    out = []
    for i, text in rows:
        ids = [j for j, t in rows if t == text]
        keep = max((j for j in ids if j is not None), default=None)
        out.append((i, keep, len(ids), i == keep))
    return sorted(map(str, out))


@pytest.mark.parametrize(
    "key, capacity",
    [(exact_dedup.hash_key, 2), (lambda t: F.pmod(F.xxhash64(t), F.lit(3)), 1000), (lambda t: F.lit(-1).cast("long"), 2)],
)
def test_copies_with_collisions(edge_docs, key, capacity):
    """Weak keys make chains of different texts; the bytes decide."""
    found = exact_dedup.exact_duplicates(edge_docs, key, capacity)
    got = sorted(str((r.doc_id, r.keep_id, r.group_size, r.kept)) for r in found.collect())
    assert got == expected_copies(edge_docs)


def test_directory_doubles(spark):
    heads = spark.range(5000).select(F.xxhash64("id").alias("key"))
    directory, depth = exact_dedup.grow_directory(heads, 80)
    slots = {r.slot: r for r in directory.collect()}
    assert set(slots) <= set(range(2**depth))
    sizes = heads.groupBy(exact_dedup._slot(F.col("key"), depth).alias("slot")).count().collect()
    buckets = {}
    for r in sizes:
        buckets[slots[r.slot].bucket] = buckets.get(slots[r.slot].bucket, 0) + r["count"]
    assert sum(buckets.values()) == 5000 and max(buckets.values()) <= 80
    assert depth > min(r.local_depth for r in slots.values())  # some buckets were not split


def test_answers_come_from_the_bucket_that_the_slot_names(spark):
    """Heads put into a wrong bucket, or a slot that points elsewhere, are not found."""
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 100).alias("text"))
    index = exact_dedup.build_index(docs, capacity=8)
    assert index.depth >= 3
    right = exact_dedup.answered(docs, index)
    assert right.where("kept").count() == 100 and right.where("group_size = 4").count() == 400
    buckets = sorted(r.bucket for r in index.heads.select("bucket").distinct().collect())
    moved = F.when(F.col("bucket") == buckets[0], buckets[1]).otherwise(F.col("bucket")).alias("bucket")
    lost = index.heads.where(F.col("bucket") == buckets[0]).count()
    wrong = exact_dedup.answered(docs, exact_dedup.Index(index.directory, index.depth, index.heads.select(moved, "key", "n")))
    assert wrong.where("group_size = 1").count() == 4 * lost > 0 and wrong.count() == 400
    turned = index.directory.select("slot", moved, "local_depth")
    wrong = exact_dedup.answered(docs, exact_dedup.Index(turned, index.depth, index.heads))
    assert wrong.where("group_size = 1").count() == 4 * lost


def test_deduplicate(edge_docs, empty_docs):
    kept = exact_dedup.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [r.text or "" for r in kept.collect()]
    assert sorted(texts) == sorted({r.text or "" for r in edge_docs.collect()})
    assert {r.key for r in kept.collect()} == {7}
    assert exact_dedup.deduplicate(empty_docs).count() == 0 and exact_dedup.exact_duplicates(empty_docs).count() == 0


@pytest.fixture(scope="module")
def items(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [
        (1, " ".join(words[5:30])), (2, "One"), (3, None), (4, "..."), (5, " ".join(words[28:34])), (None, "a B c"),
        (7, " ".join(words[40:53]) + " no"), (7, "x x"), (8, " ".join(words[5:30])),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination_edges(edge_docs, items):
    known = items.where("item_id is not null")
    docs = edge_docs.where("text is null or length(text) < 10000")  # the SQL copies a text for each of its words
    columns, expected = oracle("op2_benchmark_decontamination", documents=docs.select("doc_id", "text"), benchmark=known)
    found = decontaminate.contamination(edge_docs, known).where("n_words < 10000")
    assert rows_of(found, columns) == expected
    null_item = decontaminate.contamination(edge_docs.where("text = 'a b c'"), items).first()
    assert (null_item.n_hit, null_item.n_items, null_item.contaminated) == (3, 1, True)
    assert [m.phrase for m in null_item.matches] == ["a b c"]


def test_contamination_case_is_ascii_only(spark):
    docs = spark.createDataFrame([(1, "ÉTÉ Straße ΑΣ.Β"), (2, "été STRASSE ας β"), (3, "Été")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "été"), (2, "strasse"), (3, "ΑΣ Β")], "item_id long, text string")
    columns, expected = oracle("op2_benchmark_decontamination", documents=docs, benchmark=items)
    assert rows_of(decontaminate.contamination(docs, items), columns) == expected


def test_decontaminate(edge_docs, items, empty_docs):
    found = decontaminate.contamination(edge_docs, items)
    clean = sorted(str(r.doc_id) for r in found.where("not contaminated").collect())
    kept = decontaminate.decontaminate(edge_docs, items)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(clean)
    assert decontaminate.contamination(empty_docs, items).count() == 0
    assert decontaminate.decontaminate(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_near_matches(spark):
    words = [f"w{i}" for i in range(13)]
    docs = spark.createDataFrame(
        [(1, " ".join(words)), (2, " ".join(words[:6] + ["in", "between"] + words[6:])), (3, " ".join(words[:6] + ["in"] * 9 + words[6:]))],
        "doc_id long, text string",
    )
    items = spark.createDataFrame([(1, " ".join([words[0], *words[1:12], words[12]]))], "item_id long, text string")
    common = spark.createDataFrame([(9, " ".join(words[1:12] * 3))], "doc_id long, text string")
    found = {r.doc_id: r.gap for r in decontaminate.near_matches(docs.union(common), items, slop=3).collect()}
    assert found == {1: 0, 2: 2}


@pytest.fixture
def many_partitions(spark):
    """40 partitions for each shuffle, small ones left as they are."""
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(held, ("40", "false")):
        spark.conf.set(k, v)
    yield
    for k, v in held.items():
        spark.conf.set(k, v)


def test_small_tables_take_few_files(spark, items, monkeypatch, many_partitions):
    """However many partitions a shuffle has, tables of a few rows are one file, and no row is lost on the way."""
    written = {}

    def kept(df, name, *rows):
        written[name] = stored(df, name, *rows)
        return written[name]

    monkeypatch.setattr(decontaminate, "stored", kept)
    text = " ".join(f"w{i}" for i in range(5, 30))
    docs = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit(text + " w"), F.col("id")).alias("text"))
    assert decontaminate.contamination(docs, items).where("n_hit = 25 and n_items = 2").count() == 50
    small = {k: len(written[k].inputFiles()) for k in ("items", "windows", "anchors", "places")}
    assert small == dict.fromkeys(small, 1) and written["places"].count() == 50


def test_large_tables_take_a_file_for_each_partition_at_most(spark, many_partitions):
    spread = stored(spark.range(100), "spread", 10**9)
    assert 1 < len(spread.inputFiles()) <= 40 and spread.count() == 100
