"""Operators on single texts: extraction, spans, roles, pieces, severity, token files."""

import html
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from graphloom.llm import role_repair, sentence_spans, severity, simple8b, tag_paths, unigram
from graphloom.llm.chunks import spaced_chunks
from graphloom.llm.common import word_list
from graphloom.llm.queries import QUERIES

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a  b", " lead", "trail ", "x \n y", "a\t b", "a \x85 b", "日本 \U0001f600", "don't  it's", "x　 　y", "<|endoftext|> a"]


# main text

def article(page):
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = (html.unescape(re.sub(r"<[^>]*>", " ", p)) for p in re.split(r"<p>|</p>|</h1>", body))
    return "\n".join(t for t in (" ".join(p.split()) for p in parts) if t)


def test_pages(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = QUERIES["op1_tag_paths"](spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("just  text\nhere", "just text here"), ("<p>a &lt;b&gt;&nbsp;c", "a <b> c"),
        ("<article><p>cut off in the mid", "cut off in the mid"),
        ("<nav><a href='/'>Home</a></nav><footer>f</footer>", ""),
        (
            "<div class='content has-sidebar'><h2>Title of it</h2><p>One, two. <i>Thr</i>ee.<p>Four,\n five.<ul><li>item one, yes<li>item two</ul>"
            "</div><div id=cookie-notice><p>We use cookies, many of them, really.</p></div><section class=comments><p>Nice, very nice.</section>",
            "Title of it\nOne, two. Three.\nFour, five.\nitem one, yes\nitem two",
        ),
        ("<main><p>a, b.</p><form><p>mail, please</p></form><aside>x</aside><!-- <p>no</p> --><script>'</p>'</script><p>c</main>", "a, b.\nc"),
    ],
)
def test_main_text(page, text):
    assert tag_paths.main_text(page) == text


@pytest.mark.parametrize("wrap", ["<div>%s</div>", "<article>%s</article>", "<main>%s</main>"])
@pytest.mark.parametrize("n", [5, 20, 100, 300])
def test_article_of_any_length(n, wrap):
    p = "Some words, and more of them. " * 13
    parts = ["<h1>The title of it</h1>", "<ul><li>one<li>two<li>three<li>four</ul>", "<blockquote>A quote of it</blockquote>"]
    third = n // 3
    body = parts[0] + f"<p>{p}</p>" * third + "<h2>Part two</h2>" + f"<p>{p}</p>" * third + parts[1] + parts[2]
    body += "<h2>Part three</h2>" + f"<p>{p}</p>" * (n - 2 * third) + "<h2>Last</h2><ul><li>end one<li>end two</ul>"
    page = "<body><div><a href=/a>Home</a> <a href=/b>News</a></div>" + wrap % body + "<div>Short line</div></body>"
    got = tag_paths.main_text(page).split("\n")
    want = ["The title of it", "Part two", "one", "two", "three", "four", "A quote of it", "Part three", "Last", "end one", "end two"]
    assert [t for t in got if t != p.strip()] == want and got.count(p.strip()) == n


@pytest.mark.parametrize("second", ["article", "section"])
@pytest.mark.parametrize("n", [4, 6, 10])
def test_several_articles(n, second):
    one, two = ("".join(f"<p>{k} part {i}, with some words, and more.</p>" for i in range(m)) for k, m in (("a", 6), ("b", n)))
    page = f"<body><main><article>{one}</article><{second}>{two}</{second}></main><div>Short line</div></body>"
    assert tag_paths.main_text(page).count(" part ") == 6 + n and "Short line" not in tag_paths.main_text(page)


def test_long_page_and_empty_table(spark):
    page = "<article>" + "<p>word, and more.</p>" * 50_000 + "</article>"
    df = spark.createDataFrame([(1, None, page), (1, "u", page), (None, "u", None)], "page_id long, url string, html string")
    got = tag_paths.extract(df.withColumn("text", df.url))
    assert sorted(r.n_chars for r in got.collect()) == [0, 50_000 * 16 - 1, 50_000 * 16 - 1]
    assert tag_paths.extract(df.limit(0)).count() == 0


# sentence spans

def spans_by_hand(rows):
    seen, out = set(), {}
    for row, text in rows:
        parts = sentence_spans.units(text)
        ws = [(k, tuple(word_list(p))) for k, p in enumerate(parts) if word_list(p)]
        runs = set()
        for ends in (1, -1):
            for i in range(len(ws)):
                for j in range(i, len(ws) if ends == 1 else -1, ends):
                    a, b = min(i, j), max(i, j)
                    if b - a >= 2 and sum(len(w) for _, w in ws[a : b + 1]) >= sentence_spans.SPAN_WORDS:
                        runs.add((a, b))
                        break
        gone = set()
        for a, b in sorted(runs):
            words = tuple(w for _, w in ws[a : b + 1])
            if words in seen:
                gone |= set(range(ws[a][0], ws[b][0] + 1))
            seen.add(words)
        out[row] = "".join(p for k, p in enumerate(parts) if k not in gone)
    return out


def test_spans(spark, folder):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = {r.doc_id: r.text for r in QUERIES["op3_sentence_spans"](spark, folder).collect()}
    assert got == spans_by_hand(docs) and any(got[i] != t for i, t in docs)


def test_passage_of_one_sentence(spark):
    passage = " ".join(f"w{i}," for i in range(55)) + " end."
    rows = [(1, f"First here. {passage} And one."), (2, f"Other words.\n{passage}\nLast line."), (3, f"So it is. {passage}")]
    got = {r.doc_id: r for r in sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1].text == rows[0][1] and "w30" not in got[2].text + got[3].text
    assert "Other words." in got[2].text and "Last line." in got[2].text and "So it is." in got[3].text


def test_glued_passage(spark):
    """A passage behind and before other words of the same sentence loses all but its ends; so do unspaced scripts."""
    passage = [f"w{i}" for i in range(55)]
    glued = [" ".join([f"g{n}x{i}" for i in range(n)] + passage + [f"z{n}x{i}" for i in range(n % 4)]) for n in range(14)]
    signs = random.Random(5).sample([chr(c) for c in range(0x4E00, 0x9000)], 80)
    glued += ["".join(chr(0x9000 + 20 * n + i) for i in range(n)) + "".join(signs) for n in range(14)]
    rows = [(100 + i, t) for i, t in enumerate(glued)]
    got = {r.doc_id: r.text for r in sentence_spans.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100] == glued[0] and got[114] == glued[14]
    for i in range(1, 14):
        left, signs_left = set(got[100 + i].split()), set(got[114 + i])
        assert len(left & set(passage)) <= 25 and f"g{i}x0" in left, i
        assert len(signs_left & set(signs)) <= 40 and chr(0x9000 + 20 * i) in signs_left, i


def test_full_width_sentence_ends():
    assert sentence_spans.units("これは本。あれは「犬！」猫？\nๆ") == ["これは本。", "あれは「犬！」", "猫？\n", "ๆ"]
    assert sentence_spans.unit_words("本x y") == ["本".encode(), b"x", b"y"]


def test_spans_edges(edge_docs, empty_docs):
    got = sentence_spans.remove_repeats(edge_docs).collect()
    assert len(got) == edge_docs.count()
    assert {r.doc_id: r.text for r in got}[4] == "" and {r.doc_id: r.text for r in got}[10] == "one"
    assert all("".join(sentence_spans.units(t)) == t for t in ODD + [r.text for r in got])
    assert sentence_spans.remove_repeats(empty_docs).count() == 0


# role repair

def cheapest(roles):
    """The cost of the best repair, by trying every choice for every turn."""
    best = [float("inf")]

    def go(i, state, cost):
        if cost >= best[0]:
            return
        if i == len(roles):
            end = cost + (3.0 if state == role_repair.SYSTEM else 0.0)
            if state != role_repair.START:
                best[0] = min(best[0], end)
            return
        for b in (1, 2, 3):
            label = 0.0 if roles[i] == b else 2.0 if roles[i] == 0 else 4.0
            if b in role_repair.FOLLOWS[state]:
                go(i + 1, b, cost + label)
            if b == state:
                go(i + 1, b, cost + label + 1.0)
            for m in role_repair.FOLLOWS[state]:
                if b in role_repair.FOLLOWS[m]:
                    go(i + 1, b, cost + label + 3.0)

    go(0, role_repair.START, 0.0)
    return best[0]


NAMES = ["weird", "system", "Human", "assistant"]


@pytest.mark.parametrize("block", [3, 4096])
def test_repair_is_cheapest(spark, monkeypatch, block):
    monkeypatch.setattr(role_repair, "BLOCK", block)
    rng = random.Random(5)
    talks = [[rng.randrange(4) for _ in range(rng.randrange(1, 8))] for _ in range(60)] + [[2, 3] * 40, [2] * 30, [1], [3]]
    rows = [(i, k, NAMES[r], f"t{i}.{k}") for i, talk in enumerate(talks) for k, r in enumerate(talk)]
    rng.shuffle(rows)
    found = role_repair.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in role_repair.conversations(found).collect()}
    for i, talk in enumerate(talks):
        if len(talk) < 9:
            assert got[i].cost == cheapest(talk), talk
        marks = re.findall(r"<\|(\w+)\|>", got[i].text)
        body = marks[1:] if marks[0] == "system" else marks
        assert body and body == list(itertools.islice(itertools.cycle(["user", "assistant"]), len(body)))
        assert re.findall(r"t\d+\.\d+", got[i].text) == [f"t{i}.{k}" for k in range(len(talk))]
    assert got[60].cost == 0


def test_repair_edges(spark):
    rows = [(None, 1, "user", "a"), (None, 1, "user", "a"), (1, None, None, None), (1, 2, "assistant", ""), (2, 1, "user", "x" * 200_000)]
    kind = "conv_id long, turn long, role string, text string"
    df = spark.createDataFrame(rows, kind)
    got = {r.conv_id: r.text for r in role_repair.conversations(role_repair.repair(df.selectExpr("*", "1 place", "2 block"))).collect()}
    assert got[None] == "<|user|>\na\n\na" and got[1] == "<|user|>\n\n<|assistant|>\n" and len(got[2]) == 200_009
    assert role_repair.repair(df.limit(0)).count() == 0


# unigram pieces

@pytest.fixture(scope="module")
def pieces():
    return unigram.load_pieces(PIECES)


def test_trie(pieces):
    for i in np.flatnonzero(pieces.kinds == unigram.NORMAL)[::37]:
        state = 0
        for c in pieces.texts[i]:
            to = pieces.base[state] + pieces.codes[c]
            assert pieces.check[to] == state
            state = to
        assert pieces.leaf[state] == i


def test_viterbi_against_library(spark, folder, pieces):
    """The library's unigram model over the same pieces and scores finds no better sum of scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(PIECES, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = sentencepiece_model_pb2.TrainerSpec.UNIGRAM
    for piece, score in zip(model.pieces, pieces.scores):
        piece.score = score
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    viterbi, table = unigram.Viterbi(pieces), unigram.decoder(pieces)
    texts = ODD + [r.text for r in spark.read.parquet(f"{folder}/documents.parquet").limit(60).collect()]
    same = 0
    for text, ids in zip(texts, viterbi.encode(texts)):
        expected = library.encode(text)
        same += ids.tolist() == expected
        assert unigram.decode(ids.tolist(), table) == text
        assert library.decode(ids.tolist()) == library.decode(expected)
        # bytes of unknown characters are left out: both have the same ones
        score = [sum(pieces.scores[i] for i in x if pieces.kinds[i] == unigram.NORMAL) for x in (ids.tolist(), expected)]
        assert score[0] == pytest.approx(score[1], abs=1e-2)
    assert same > 0.8 * len(texts)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=8))
def test_pieces_round_trip(texts):
    viterbi = unigram.Viterbi(test_pieces_round_trip.pieces)
    table = unigram.decoder(viterbi.p)
    texts = [t.replace(unigram.LITERAL, "") for t in texts]
    for text, ids in zip(texts, viterbi.encode(texts)):
        assert unigram.decode(ids.tolist(), table) == text
        marked = ["▁" + c for c in spaced_chunks(text) if c and "▁" not in c]
        if marked:
            assert viterbi.many(marked) == [viterbi.one(m) for m in marked]


test_pieces_round_trip.pieces = unigram.load_pieces(PIECES)


def test_encode_documents(edge_docs, empty_docs):
    got = unigram.encode_documents(edge_docs, PIECES).collect()
    assert len(got) == edge_docs.count() and all(r.round_trip and len(r.ids) == r.n_tokens for r in got)
    assert {r.doc_id: r.n_tokens for r in got}[4] == 0
    assert unigram.encode_documents(empty_docs, PIECES).count() == 0


# severity

def test_held_out_severity(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fit_on, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    model = severity.train(docs, fit_on)
    rows = docs.join(held.select("doc_id", F.col("toxic").alias("y")), "doc_id").cache()
    got = severity.severity(rows, fit_on, model).join(rows.select("doc_id", "y"), "doc_id").collect()
    bad, good = [r for r in got if r.y], [r for r in got if not r.y]
    assert np.mean([r.toxic for r in bad]) > 0.75 and np.mean([r.toxic for r in good]) < 0.01
    assert all(r.p1 >= r.p2 >= r.p3 and abs(r.p1 + r.p2 + r.p3 - r.expected_severity) < 1e-9 for r in got)
    assert np.mean([r.expected_severity for r in bad]) > 20 * np.mean([r.expected_severity for r in good])


def test_severity_edges(spark, edge_docs, empty_docs):
    labels = spark.createDataFrame([(1, 0), (3, 1), (3, None), (None, 1), (99, 1)], "doc_id long, toxic int")
    assert severity.severity(edge_docs, labels).count() == edge_docs.count()
    untrained = severity.severity(edge_docs, labels.limit(0)).collect()
    assert len(untrained) == edge_docs.count() and not any(r.toxic or r.expected_severity for r in untrained)
    assert severity.severity(empty_docs, labels).count() == 0
    assert severity.not_toxic(edge_docs, labels).columns == edge_docs.columns


# token files

@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60_000) | st.integers(0, 3), max_size=400), st.sampled_from([1, 7, 64, 1024]))
def test_simple8b_round_trip(ids, block):
    values = np.array(ids, dtype=np.uint64)
    words, offsets, escapes = simple8b.pack(values, block)
    assert simple8b.unpack(words, offsets, escapes, len(values), block).tolist() == ids


def test_runs_fill_words():
    assert len(simple8b.pack(np.ones(6000, np.uint64), 6000)[0]) == 100
    assert len(simple8b.pack(np.full(6000, 2**15, np.uint64), 6000)[0]) == 2000


def expected_tokens(rows):
    from tokenizers import Tokenizer

    tokenizer, at, out = Tokenizer.from_file(BPE), 0, []
    for i, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_files(spark, folder):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op10_token_files"](spark, folder).collect())
    assert got == expected_tokens(rows)


def test_token_files_edges(spark, edge_docs, empty_docs):
    got = sorted(simple8b.token_files(edge_docs, BPE, with_ids=True).collect(), key=lambda r: r.start)
    texts = {(r.doc_id, r.text) for r in edge_docs.collect()}
    assert [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda d: (d is not None, d or 0))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in got) == sorted(
        (str(i), n, c) for i, _, n, c in expected_tokens([(r.doc_id, r.text) for r in edge_docs.collect()])
    )
    assert all(r.ids[-1] == 0 and len(r.ids) == r.n_tokens for r in got) and texts
    assert simple8b.token_files(empty_docs, BPE).count() == 0
    odd = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    assert sorted(tuple(r) for r in simple8b.token_files(odd, BPE).collect()) == expected_tokens(list(enumerate(ODD)))


def test_endings_share_pieces(monkeypatch):
    encoder, met = simple8b.ChunkEncoder(BPE), []
    monkeypatch.setattr(simple8b.ChunkEncoder, "_ids", lambda self, texts, run=simple8b.ChunkEncoder._ids: met.extend(texts) or run(self, texts))
    words = [f"{a}{b}{c}or" for a in ("Hest", "bleed", "thï") for b in ("ene", "ando", "aux") for c in ("lich", "ción", "9")]
    texts = [" ".join(f"{w}{end}" for w in words) for end in ("", ".", ",", "!", "***", "&&&", ".\nQue", "\nQue", "?!\nQue")]
    flat, n = encoder.encode(pa.array(texts), 0)
    assert [i for t in texts for i in encoder.tokenizer.encode(t, add_special_tokens=False).ids + [0]] == flat.tolist()
    assert sum(n) == len(flat) and sum(len(t) for t in met) < 1.5 * len(texts[0])
    met.clear()
    encoder.encode(pa.array([f"x {w}{end}" for w in words for end in ("?", "%", ";\nQue")]), 0)
    assert sorted(met) == [" x", "%", ";", "?", "x"]


@pytest.mark.parametrize("memory", [0, 3, 600_000])
def test_pieces_of_odd_texts(memory):
    encoder, rng = simple8b.ChunkEncoder(BPE, memory), random.Random(8)
    parts = [*"ab's\u00e91.,;!?*$%#&\n\n\n\t \x0b\x85\u3000\u00f1\u65e5\u00b2\u00d7_-<|>", "<|endoftext|>", "'s", "ll", " ", "  ", ".\n", ".\n\n"]
    texts = ODD + ["".join(rng.choices(parts, k=rng.randrange(1, 40))) for _ in range(3000)]
    for _ in range(2):
        flat, n = encoder.encode(pa.array(texts), 0)
        for text, ids in zip(texts, np.split(flat, np.cumsum(n)[:-1])):
            assert ids.tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [0], text
    assert len(encoder.known) <= memory
    assert [len(x) for x in encoder.encode(pa.array([], pa.string()), 0)] == [0, 0]
    assert [x.tolist() for x in encoder.encode(pa.array([""], pa.large_string()), 7)] == [[7], [1]]
    large, sizes = encoder.encode(pa.array(texts, pa.large_string()), 0)
    assert (large == flat).all() and (sizes == n).all()


def test_marks_of_added_tokens_cut_nothing(tmp_path):
    from tokenizers import AddedToken, Tokenizer

    other = Tokenizer.from_file(BPE)
    other.add_tokens([AddedToken("st.", normalized=False), AddedToken("u!!")])
    other.save(str(tmp_path / "other.json"))
    encoder = simple8b.ChunkEncoder(str(tmp_path / "other.json"))
    assert not set(".!") & set(encoder.marks) and "," in encoder.marks
    text = "first. thou!! first, thou!\nfirst."
    assert encoder.encode(pa.array([text]), 0)[0].tolist() == other.encode(text, add_special_tokens=False).ids + [0]
    other.add_tokens([AddedToken("\nfi", normalized=False)])
    other.save(str(tmp_path / "lines.json"))
    encoder = simple8b.ChunkEncoder(str(tmp_path / "lines.json"))
    assert encoder.marks == "" and encoder.encode(pa.array([text]), 0)[0].tolist() == other.encode(text, add_special_tokens=False).ids + [0]
