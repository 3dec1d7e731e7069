"""Near-duplicates, link trust, and the pipeline."""

import collections
import itertools
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import decontaminate, exact_dedup, host_trust, order_minhash, severity
from graphloom.llm.common import BATCH_MB, components, released, small_batches, word_list
from graphloom.llm.queries import QUERIES


def classes_by_hand(rows):
    """The smallest id of each class, from all pairs of texts that share a k-mer."""
    kmers = {i: order_minhash.labelled_kmers(word_list(t)) for i, t in rows}
    holders = collections.defaultdict(list)
    for i, found in kmers.items():
        for x in found.tolist():
            holders[x].append(i)
    shared = collections.Counter(p for ids in holders.values() for p in itertools.combinations(ids, 2))
    root = {i: i for i in kmers}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        m, k = len(kmers[a]), len(kmers[b])
        if order_minhash.is_similar(m, k, n) and order_minhash.is_similar(m, k, lcs(kmers[a], kmers[b])):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in kmers}


def lcs(a, b):
    """The longest common sequence by the full table, row by row."""
    row = np.zeros(len(b) + 1, int)
    for x in a:
        row[1:] = np.maximum.accumulate(np.maximum(row[1:], row[:-1] + (b == x)))
    return int(row[-1])


def test_near_duplicates(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = QUERIES["op9_order_minhash"](spark, folder).collect()
    expected = classes_by_hand(rows)
    assert {r.doc_id: r.class_id for r in got} == expected
    sizes = collections.Counter(expected.values())
    assert all(r.class_size == sizes[r.class_id] and r.kept == (r.doc_id == r.class_id) for r in got)
    assert len(sizes) < len(rows)


def test_alignment_band_loses_no_link():
    rng = np.random.default_rng(3)
    for _ in range(60):
        a = [b"w%d" % x for x in rng.integers(0, 50, 120)]
        b = list(a)
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(0, len(b)))
            b[at : at + int(rng.integers(0, 6))] = [b"n%d" % x for x in rng.integers(0, 9, int(rng.integers(0, 8)))]
        x, y = order_minhash.labelled_kmers(a), order_minhash.labelled_kmers(b)
        whole, band = lcs(x, y), order_minhash.band_width(len(x), len(y))
        assert order_minhash.aligned(x, y, 10**9) == whole
        assert order_minhash.is_similar(len(x), len(y), order_minhash.aligned(x, y, band)) == order_minhash.is_similar(
            len(x), len(y), whole
        )


def test_sketch_keeps_order():
    words = [b"w%d" % i for i in range(200)]
    kmers = order_minhash.labelled_kmers(words)
    assert (order_minhash.sketch(kmers) == order_minhash.sketch(kmers.copy())).all()
    turned = np.concatenate([kmers[100:], kmers[:100]])  # the same k-mers in another order
    assert (order_minhash.sketch(kmers) == order_minhash.sketch(turned)).mean() < 0.3
    edited = order_minhash.labelled_kmers(words[:50] + [b"x"] + words[51:])
    assert (order_minhash.sketch(kmers) == order_minhash.sketch(edited)).any()


def test_large_group_and_strays(spark):
    """A group of near copies, a text that is near to some of them only, and texts that share a long passage."""
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base[:i] + [f"e{i}"] + base[i + 1 :])) for i in range(100)]
    rows += [(1000 + i, " ".join(base[:70] + [f"q{i}x{k}" for k in range(60)])) for i in range(30)]
    chain = base[:60] + [f"c{k}" for k in range(9)] + base[69:]
    rows += [(2000, " ".join(chain)), (2001, " ".join(chain[:20] + ["d1"] + chain[21:]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
    assert got == classes_by_hand(rows)


def test_short_texts_are_candidates(spark):
    """Every truncation, at either end, of texts of 5 to 30 words, and of some around the bound of short texts."""
    rows = []
    for n in (*range(5, 31), 50, 54, 55, 60, 66):
        words = [f"t{n}x{i}" for i in range(n)]
        cuts = [words[a : n - b] for a in range(n // 5 + 2) for b in range(n // 5 + 2 - a)]
        kmers = [order_minhash.labelled_kmers([w.encode() for w in c]) for c in cuts]
        for x, y in itertools.combinations(kmers, 2):
            if order_minhash.linked_kmers(x, y) and min(len(x), len(y)) <= order_minhash.SHORT:
                assert np.isin(order_minhash.bucket_keys(x), order_minhash.bucket_keys(y)).any()
        rows += [(1000 * n + i, " ".join(c)) for i, c in enumerate(cuts)]
    rows += [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (3, "k l m n o p q r s"), (4, "j k l m n o p q r s")]
    got = order_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r.class_id for r in got}
    assert got == classes_by_hand(rows) and got[2] == 1 and got[4] == 3


def test_near_edges(edge_docs, empty_docs):
    got = order_minhash.near_duplicates(edge_docs).collect()
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert len(got) == edge_docs.count()
    assert by_id[1].class_id == by_id[2].class_id == by_id[3].class_id == 1 and by_id[1].class_size == 5
    assert by_id[8].class_id == 7 and by_id[10].class_id == 9
    assert by_id[4].class_size == by_id[5].class_size == by_id[13].class_size == 1 and by_id[13].kept
    kept = order_minhash.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 1, 4, 5, 6, 7, 9, 11, 12, 12, 13, 14]
    assert order_minhash.near_duplicates(empty_docs).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.v: r.c for r in components(links).collect()} == {i: 0 for i in range(41)} | {100: 100, 101: 100}


# link trust

PAGES = [
    (1, "http://Good.example.net/en/1", '<a href="http://mid.com/x">m</a> <A class=x HREF=//far.com/>f</a>'),
    (2, "https://good.example.net/en/2?q", "<a href='/own'>o</a>"),
    (3, "http://mid.com/p", '<a href="http://end.com">e</a><a href="mailto:x@y.z">m</a>'),
    (4, "http://bad.net/x", "<p>"),
    (5, "http://liar.com/", '<a href="http://bad.net/a">b</a><a href="http://bad.net/b">b</a>'),
    (6, "http://friend.com/", '<a href="http://liar.com/">b</a>'),
    (7, None, None), (8, "no scheme", ""), (9, "http://x.org/fr/", None), (9, "http://x.org/de", None),
    (10, "ftp://shop.example.com/de/1", None), (11, "http://bad.net", None), (15, "http://bad.net/y", None), (12, "http://notexample.net/en/", None),
    (13, "a://b/c://d", None), (14, "http://h.org\n/fr/", None),
]


def trust_by_hand(edges, mass, damping=host_trust.DAMPING, rounds=150):
    if not mass:
        return {}
    seed = {h: m / sum(mass.values()) for h, m in mass.items()}
    out = collections.Counter()
    for (a, _), n in edges.items():
        out[a] += n
    score = dict(seed)
    for _ in range(rounds if edges else 0):
        sent = collections.defaultdict(float)
        for (a, b), n in edges.items():
            sent[b] += score.get(a, 0) * n / out[a]
        back = 1 - damping + damping * (1 - sum(sent.values()))
        score = {h: seed.get(h, 0) * back + damping * sent.get(h, 0) for h in {*seed, *sent}}
    return score


def test_verdicts(spark):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {(r.page_id, r.path): r for r in host_trust.verdicts(df).collect()}
    assert len(got) == len(PAGES)
    rules = {k: (r.host, r.rule, r.verdict) for k, r in got.items()}
    assert rules[1, "/en/1"] == ("good.example.net", "example.net/en/", "allow") and got[2, "/en/2"].rule == "example.net/en/"
    assert rules[4, "/x"] == ("bad.net", "net/", "block") and rules[9, "/fr/"][1:] == ("org/fr/", "allow")
    assert rules[9, "/de"] == ("x.org", None, "allow") and rules[10, "/de/1"][1:] == ("example.com/de/", "block")
    assert rules[12, "/en/"][1:] == ("net/", "block")
    assert rules[13, "/c://d"][0] == "b" and rules[14, "/fr/"][0] == "h.org\n"
    assert rules[7, ""] == rules[8, ""] == ("", None, "allow")
    assert rules[5, "/"][1:] == (None, "block") and rules[6, "/"][1:] == (None, "block")  # they lead to a blocked host
    assert rules[3, "/p"][1:] == (None, "allow") and got[3, "/p"].trust > 0
    assert rules[11, ""][1] is None and rules[11, ""][2] == "block"  # no path, so no rule; its host is blocked

    edges = {("good.example.net", "mid.com"): 1, ("good.example.net", "far.com"): 1, ("mid.com", "end.com"): 1,
             ("liar.com", "bad.net"): 2, ("friend.com", "liar.com"): 1}
    trust = trust_by_hand(edges, {"good.example.net": 2})
    turned = {(b, a): n for (a, b), n in edges.items()}
    bad = {"shop.example.com": 1, "notexample.net": 1, "bad.net": 2}
    distrust = trust_by_hand(turned, bad)
    scores = {r.host: r for r in host_trust.host_scores(df).collect()}
    assert all(scores[h].trust == pytest.approx(x) for h, x in trust.items())
    assert all(scores[h].distrust == pytest.approx(x) for h, x in distrust.items())


def test_only_links_that_a_page_shows(spark):
    html = (
        '<a data-href="//b.com/">1</a><!-- <a href="//c.com/"> --><script>x = \'<a href="//d.com/">\'</script>'
        '<STYLE>/* <a href="//e.com/"> */</STYLE><abbr href="//f.com/">2</abbr><a title="t"\nhref="//g.com/">3</a>'
        '<a href="//g.com/2">4</a>' + "<p>long</p> " * 200_000 + '<a href="//h.com/">5</a><!-- never closed <a href="//i.com/">'
    )
    pages = spark.createDataFrame([("http://a.com/", html), ("http://a.com/", None), (None, html)], "url string, html string")
    assert {tuple(r) for r in host_trust.host_edges(pages).collect()} == {("a.com", "g.com", 2), ("a.com", "h.com", 1)}


def test_query_on_a_table_with_links(spark, tmp_path):
    """Hosts that link to each other: verdicts are those of the converged scores where no rule fits."""
    rng = np.random.default_rng(5)
    names = [f"h{i}.com" for i in range(20)] + ["bad.net", "worse.net", "good.example.net"]
    edges, rows = collections.Counter(), []
    for page in range(120):
        src = names[int(rng.integers(len(names)))]
        to = [names[int(x)] for x in rng.integers(len(names), size=3)]
        edges.update((src, d) for d in to if d != src)
        path = "en/" if src == "good.example.net" else ""
        rows.append((page, f"http://{src}/{path}{page}", "".join(f'<a href="https://{d}/x">x</a>' for d in to)))
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op6_link_trust"](spark, str(tmp_path)).collect()
    pages_of = collections.Counter(r[1].split("/")[2] for r in rows)
    trust = trust_by_hand(edges, {"good.example.net": pages_of["good.example.net"]})
    distrust = trust_by_hand({(b, a): n for (a, b), n in edges.items()}, {h: pages_of[h] for h in ("bad.net", "worse.net")})
    assert len(got) == len(rows) and {r.verdict for r in got if r.rule is None} == {"allow", "block"}
    for r in got:
        ruled = "block" if r.rule == "net/" else "allow" if r.rule else None
        assert r.verdict == (ruled or ("block" if distrust.get(r.host, 0) > trust.get(r.host, 0) else "allow")), r


def test_propagation_matches_matrix(spark, empty_docs):
    rng = np.random.default_rng(0)
    edges = {(f"h{a}", f"h{b}"): int(n) for a, b, n in rng.integers(1, 30, (120, 3)) if a != b}
    mass = {"h1": 3.0, "h2": 1.0}
    got = host_trust.propagate(
        spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n long"),
        spark.createDataFrame(list(mass.items()), "host string, mass double"),
    )
    expected = trust_by_hand(edges, mass)
    scores = {r.host: r.score for r in got.collect()}
    assert all(math.isclose(scores.get(h, 0), x, abs_tol=1e-9) for h, x in expected.items())
    assert math.isclose(sum(scores.values()), 1)


def test_trust_reaches_far(spark):
    """A chain of 30 links is reached to its end at any tolerance; scores solve the equations of a matrix."""
    chain = spark.createDataFrame([(f"c{i}", f"c{i + 1}", 1) for i in range(30)], "src string, dst string, n long")
    far = host_trust.propagate(chain, spark.createDataFrame([("c0", 1.0)], "host string, mass double"), tolerance=0.1)
    got = {r.host: r.score for r in far.collect()}
    assert len(got) == 31 and all(got[f"c{i}"] > got[f"c{i + 1}"] > 0 for i in range(30))
    assert host_trust.propagate(chain, chain.select(F.col("src").alias("host"), F.lit(1.0).alias("mass")).limit(0)).count() == 0

    hosts, damping = [f"h{i}" for i in range(12)], 0.85
    edges = {(a, (a + k) % 11): k for a in range(11) for k in (1, 3)} | {(4, 11): 2}  # h11 has no links
    seed = np.zeros(12)
    seed[[0, 5]] = 0.75, 0.25
    moves = np.zeros((12, 12))
    for (a, b), n in edges.items():
        moves[b, a] = n / sum(m for (c, _), m in edges.items() if c == a)
    moves[:, 11] = seed
    expected = np.linalg.solve(np.eye(12) - damping * moves, (1 - damping) * seed)
    scores = host_trust.propagate(
        spark.createDataFrame([(hosts[a], hosts[b], n) for (a, b), n in edges.items()], "src string, dst string, n long"),
        spark.createDataFrame([("h0", 3.0), ("h5", 1.0)], "host string, mass double"),
    )
    assert {r.host: r.score for r in scores.collect()} == pytest.approx(dict(zip(hosts, expected)), abs=1e-9)


def test_no_pages(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert host_trust.verdicts(df).count() == 0


# the pipeline

def test_pipeline_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "near_dedup", "decontamination", "sentencepiece"]
    labels, benchmark = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("labels", "benchmark"))
    toxic = {r.doc_id for r in severity.severity(docs, labels).where("toxic").collect()}
    rest = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id not in toxic)
    last = {t: i for i, t in rest}
    rest = [(i, t) for i, t in rest if last[t] == i]
    classes = classes_by_hand(rest)
    rest = [(i, t) for i, t in rest if classes[i] == i]
    frame = spark.createDataFrame(rest, "doc_id long, text string")
    bad = {r.doc_id for r in decontaminate.contamination(frame, benchmark).where("contaminated").collect()}
    expected = [i for i, _ in rest if i not in bad]
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_id for r in got) == expected and all(r.round_trip for r in got)
    assert 0 < len(expected) < docs.count()


def test_stages_keep_columns(spark, folder, edge_docs, empty_docs):
    for docs in (edge_docs, empty_docs):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns, name
    assert exact_dedup.deduplicate(edge_docs).count() <= edge_docs.count()


BATCH_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.mark.parametrize("name", ["toxicity", "near_dedup", "sentencepiece"])
def test_stages_hand_workers_small_batches(spark, folder, empty_docs, name):
    """12 MB in fewer rows than Spark puts into one batch."""
    def widest(batches):
        yield pa.record_batch([pa.array([max(b.nbytes for b in batches)])], names=["n"])

    docs = spark.range(0, 6_000, 1, 1).select(F.repeat(F.lit("word "), 400).alias("text"))
    spark.conf.unset(BATCH_BOUND)
    try:
        dict(corpus_pipeline.STAGES)[name](spark, empty_docs, folder)
        assert docs.mapInArrow(widest, "n long").first().n < 2 * BATCH_MB << 20
    finally:
        spark.conf.unset(BATCH_BOUND)


def test_smaller_batches_stay(spark):
    try:
        lowered = f"{BATCH_MB}m"
        for bound, after in (("100k", "100k"), ("1mb", "1mb"), ("2097152", "2097152"), ("64m", lowered), ("1g", lowered)):
            spark.conf.set(BATCH_BOUND, bound)
            small_batches(spark)
            assert spark.conf.get(BATCH_BOUND) == after
    finally:
        spark.conf.unset(BATCH_BOUND)


def test_tasks_give_memory_back():
    """180 MB are freed below a piece that stays."""
    def held():
        with open("/proc/self/statm") as f:
            return int(f.read().split()[1]) * 4096 >> 20

    stays = []

    def run(batches):
        for batch in batches:
            pieces = [bytes(600) for _ in range(300_000)]
            stays.append(bytes(600))
            del pieces
            yield batch

    before, batch = held(), pa.record_batch([pa.array([1])], names=["n"])
    assert list(released(run)(iter([batch]))) == [batch]
    assert held() < before + 60
