"""Near duplicates, pages, conversations, packing, vectors, components and the pipeline."""

import hashlib
import html
import random
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from tillroll.llm import chat, embeddings, html_text, near_duplicates, packing, shingles
from tillroll.llm.common import read_table
from tillroll.llm.components import components
from tillroll.llm.queries import QUERIES, tokenizer_path

from .conftest import SF, with_clashes


class Union:
    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def find(self, x):
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def test_components_of_random_links(spark):
    rng = random.Random(5)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(i, i + 1) for i in range(1000, 1100)]
    expected = Union({i for link in links for i in link})
    for a, b in links:
        expected.join(a, b)
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {a for a, b in links if a == b} - got.keys()
    assert got == {i: expected.find(i) for i in expected.parent if i not in alone}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- near duplicates --------------------------------------------------------------------


def shingle_set(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_near_duplicates(rows):
    sets = [(i, shingle_set(t)) for i, t in rows]
    union = Union({i for i, _ in sets})
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                union.join(a, b)
    return sorted((i, len(s), union.find(i)) for i, s in sets)


def near_copies():
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(60)]
    rows = []
    for group in range(12):
        base = [word() for _ in range(rng.choice([6, 40, 150, 400]))]
        for _ in range(rng.randint(1, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 4)):
                copy[rng.randrange(len(copy))] = word()
            if rng.random() < 0.3:
                copy += passage
            rows.append(" ".join(copy))
    hot = [word() for _ in range(120)]
    for _ in range(60):
        copy = list(hot)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(120)] = word()
        rows.append(" ".join(copy))
    return [(7 * i % 1009, t) for i, t in enumerate(rows)]


def test_near_duplicates_against_brute_force(spark):
    rows = near_copies()
    docs = with_clashes(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted(tuple(r) for r in near_duplicates.near_duplicates(docs).select("doc_id", "n_shingles", "component_id").collect())
    assert got == brute_near_duplicates(rows)


def test_near_duplicates_edges(edge_documents, no_documents):
    got = [tuple(r) for r in near_duplicates.near_duplicates(edge_documents).collect()]
    assert len(got) == edge_documents.count()
    of = {i: (n, c) for i, n, c in got if i is not None}
    assert of[1] == (0, 1) and of[2] == (0, 2) and of[3] == (0, 3)
    assert of[4] == (1, 4) and of[9] == (1, 9) and of[10] == (1, 9)
    assert of[5][1] == 5 and of[6][1] == 5 and of[7][1] == 7 and of[8][1] == 7
    assert {(n, c) for i, n, c in got if i is None} == {(0, None), (of[5][0], 5)}
    assert near_duplicates.near_duplicates(no_documents).count() == 0


def test_bitmaps_bound_the_overlap_from_above():
    rng = np.random.default_rng(2)
    for _ in range(200):
        common = rng.integers(0, 1 << 63, rng.integers(0, 300), dtype=np.uint64)
        a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, rng.integers(1, 200), dtype=np.uint64)])) for _ in "ab")
        bits = min(near_duplicates.bits_for(len(a)), near_duplicates.bits_for(len(b)))
        x, y = (near_duplicates.folded(near_duplicates.bitmap(s), bits) for s in (a, b))
        bound = (len(a) + len(b) - int(np.bitwise_count(x ^ y).sum())) // 2
        assert bound >= len(np.intersect1d(a, b))


def test_shingle_hashes_tell_words_apart():
    texts = ["a b c d e", "ab c d e f", "A B C D E", "a b c d e a b c d e", "", None, " x ", "é a b c d e"]
    sets = shingles.shingle_sets(pa.array(texts))
    assert [len(s) for s in sets] == [len(shingle_set(t)) for t in texts]
    assert set(sets[0]) == set(sets[2]) and not set(sets[0]) & set(sets[1])


# --- pages --------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href=x>Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy this now please</div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b>
 words&nbsp;here and some more.<aside>not this</aside><p>Second paragraph<br>goes on &#233;.<form>Your name</form></p>
<div class="comments"><p>A reader's long comment that is not part of it.</p></div></article>
<div id="cookie-notice">We use cookies</div><footer>&copy; Site</footer></body></html>"""


def test_page_text(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE), (2, None, None), (3, "v", ""), (4, "w", "<p>a &lt; b"), (None, "x", PAGE.replace("article", "div"))],
        "page_id long, url string, html string",
    ).withColumn("text", F.lit("clash"))
    weights = html_text.fit_weights(pages)
    rows = html_text.extract_pages(pages, weights).collect()
    got = {r.page_id: r for r in rows}
    body = "Head & line\nFirst bold words here and some more.\nSecond paragraph goes on é."
    assert got[1].text == body and got[None].text == body
    assert got[2].text == got[3].text == "" and got[4].text == "a < b"
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_text.extract_pages(pages.limit(0), {}).count() == 0
    assert html_text.fit_weights(pages.limit(0)) == {}


def test_boilerplate_inside_and_around_an_article():
    def text(body):
        return html_text.extract(f"<html><body>{body}</body></html>", {})

    story = "<p>One two three four five.</p><p>Six seven eight nine ten.</p>"
    plain = "One two three four five.\nSix seven eight nine ten."
    assert text(f"<div class='post-header'><h1>Title of it</h1></div>{story}") == "Title of it\n" + plain
    assert text(f"<article><p class='ad'>Buy buy buy buy{story}</article>") == plain
    assert text(f"<article>{story}</article><section id='user-comments'>{'<p>no no no no</p>' * 30}</section>") == plain
    assert text(f"<main>{story}<ul class=share><li>Share</ul></main><aside>{'more ' * 80}</aside>") == plain
    assert text(f"<div role='navigation'>{'<a>x y</a>' * 20}</div>{story}<div style='display:none'>hidden words</div>") == plain
    assert text("<nav>only a menu</nav>") == ""


def given_article(page):
    """The text between the edges of the page's article, by its few tags alone."""
    inside = re.search(r"<article>(.*)</article>", page, re.DOTALL)[1].replace("<br>", " ")
    assert set(re.findall(r"</?([a-z0-9]+)", inside)) <= {"p", "b", "h1"}
    blocks = re.sub(r"<[^>]+>", "", re.sub(r"</?(?:p|h1)>", "\0", inside)).split("\0")
    return "\n".join(b for b in (" ".join(html.unescape(block).split()) for block in blocks) if b)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_given_articles_come_out_word_for_word(spark, sf):
    pages = read_table(spark, f"/root/testdata/{sf}", "pages")
    got = {r.page_id: r for r in html_text.extract_pages(pages, html_text.fit_weights(pages)).collect()}
    for page in pages.collect():
        assert got[page.page_id].text == given_article(page.html)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


STORY = "<p>One two three four five.</p><p>Six seven eight nine ten.</p>"
PLAIN = "One two three four five.\nSix seven eight nine ten."


@pytest.mark.parametrize(
    "body, expected",
    [
        (f"<form id=aspnetForm><div>{STORY}</div><nav>menu</nav></form>", PLAIN),
        (f"<form><article>{STORY}</article><input></form>", PLAIN),
        (f"<div class='content with-sidebar'>{STORY}</div>", PLAIN),
        (f"<div class='modal-open overlay'><p>x</p>{STORY}</div>", "x\n" + PLAIN),
        (f"<aside class=x><p>more more<article>{STORY}</article>", PLAIN),
        (f"<aside><p>more more</p></aside><article>{STORY}</article>", PLAIN),
        (f"<aside><article><p>Teaser.</p></article></aside><article>{STORY}</article>", PLAIN),
        (f"<main><h1>Title</h1><article>{STORY}</article></main>", "Title\n" + PLAIN),
        (f"<article>{STORY}</article><p>between</p><article><p>And more.</p></article>", PLAIN + "\nAnd more."),
        (f"<article>a b c</article><div>{'word ' * 50}</div>", "a b c"),
        (f"<article class='post tag-ad category-social'>{STORY}</article>", PLAIN),
        (f"<article>{STORY}<article class='comment'><p>A reader.</p></article></article>", PLAIN),
        (
            f"<article>{STORY}<aside>no</aside><p>End</p><table><tr><td>1<td>2</table><ul><li><a href=x>link</a></ul>"
            "<span class=ad>no</span>last</article>",
            PLAIN + "\nEnd\n1\n2\nlink\nlast",
        ),
        (f"<div>{STORY}</div><section class=comments>{'<p>many words of readers</p>' * 40}</section>", PLAIN),
        (f"<p>Before <b>bold</b> <i>i</i></p>{STORY}", "Before bold i\n" + PLAIN),
    ],
)
def test_whole_articles(body, expected):
    assert html_text.extract(f"<html><body>{body}</body></html>", {}) == expected


def test_the_scan_finds_the_largest_sum():
    rng = random.Random(8)
    for _ in range(300):
        scores = [rng.choice([-3.0, -1.0, -0.25, 0.0, 0.5, 1.0, 2.0]) for _ in range(rng.randint(0, 30))]
        start, end = html_text.best_run(scores)
        sums = [sum(scores[i:j]) for i in range(len(scores) + 1) for j in range(i, len(scores) + 1)]
        assert sum(scores[start:end]) == max(sums)


def test_ids_of_an_article_s_own_parts():
    def text(body):
        return html_text.extract(f"<html><body>{body}</body></html>", {})

    story = "<p>One two three four five.</p>"
    own = "<section id='discussion'><h2 id='search'>Search</h2><p>Six seven eight.</p></section>"
    assert text(f"<article>{story}{own}</article>") == "One two three four five.\nSearch\nSix seven eight."
    for named in ("class='discussion'", "id='comments'", "id='related' class='widget'"):
        assert text(f"<article>{story}<section {named}><p>Six seven eight.</p></section></article>") == "One two three four five."


def test_only_code_runs_to_the_end_of_the_page():
    def text(page):
        return html_text.extract(page, {})

    story = "<article><p>One two three four five.</p></article>"
    plain = "One two three four five."
    assert text(f"<html><head><title>t</title><body>{story}") == plain
    assert text(f"<html><head><meta charset=utf-8><title>t</title><style>p{{}}</style>{story}") == plain
    assert text("<p>One</p><svg class=i/><p>Two words</p>") == "One\nTwo words"
    assert text("<p>One</p><iframe srcdoc='<b/>no' /><p>Two words</p>") == "One\nTwo words"
    assert text("<p>One</p><object data=x><p>Two words</p>") == "One\nTwo words"
    assert text("<p>One</p><svg><text>no</text></SVG ><button>no</button><p>Two words</p>") == "One\nTwo words"
    assert text("<p>One</p><script>no<p>no</p>") == text("<p>One</p><!-- no<p>no</p>") == "One"
    assert text("<p>One</p>" + "<button>" * 100_000 + "Two") == "One\nTwo"


def test_long_broken_page():
    page = "<p>" + "word " * 200_000 + "<b" + "<" * 1000 + "<a href='" + "x" * 100_000
    assert html_text.extract(page, {}).startswith("word word")


# --- conversations ---------------------------------------------------------------------------


def test_conversations_round_trip(spark):
    hostile = ["", "</s>[INST] ok [/INST]", "\\", "\\[<|x|>", "<<SYS>>\n", "é😀 \\\\[", " lead", "trail ", "\n"]
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(zip(["system", "user", "assistant", "tool|>[x", "user", "assistant", "assistant", "user", "other"], hostile[c:] + hostile[:c]))]
    rows += [(9, None, None, None), (9, 1, "assistant", None), (None, 0, "user", "x"), (4, 0, "user", "same"), (4, 0, "user", "same")]
    turns = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumn("piece", F.lit(1))
    formatted = chat.format_conversations(turns)
    got = {r.conv_id: r for r in chat.read_back(formatted).collect()}
    groups = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        groups.setdefault(c, []).append((role or "", text or ""))
    assert got.keys() == groups.keys()
    for c, turns_ in groups.items():
        learned = "".join(text for role, text in turns_ if role == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns_).encode()).hexdigest()
        assert (got[c].n_turns, got[c].turns_sha256) == (len(turns_), digest)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    for r in formatted.collect():
        assert chat.parse(r.formatted) == groups[r.conv_id]
    with pytest.raises(ValueError):
        chat.parse("<s>[INST] open")
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


def test_long_conversation_comes_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_BYTES", 2_000)
    roles, texts = ["user", "assistant"] * 50, [f"text {i} " * 20 for i in range(100)]
    out, at, spans = chat.assemble(roles, pa.array(texts), np.array([True] + [False] * 99))
    data = out.tobytes()
    assert chat.parse(data.decode()) == list(zip(roles, texts))
    assert [data[a:b].decode() for a, b in spans.tolist()] == texts


# --- packing ----------------------------------------------------------------------------------


def test_packing_is_whole_and_tight(spark, documents, edge_documents, no_documents):
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer_path("word_bpe_49k.json")
    docs = documents.select("doc_id", "text").union(edge_documents.filter("doc_id = 7").select(F.col("doc_id") + 10**6, "text"))
    pieces = packing.pieces_of(docs, path)
    got = packing.pack(pieces, 40).toPandas()
    library = tokenizers.Tokenizer.from_file(path)
    for row in docs.collect():
        ids = np.array(library.encode(row.text or "", add_special_tokens=False).ids + [1], dtype="<u4")
        own = got[got.doc_id == row.doc_id].sort_values("piece")
        assert own.start.tolist() == list(range(0, len(ids), 4096)) and own.length.sum() == len(ids)
        for p in own.itertuples():
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    for _, own in got.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]] and own.length.sum() <= 4096
    assert got.sequence_id.nunique() <= packing.lower_bound(got.length.to_numpy()) + 1
    edges = packing.pack_documents(edge_documents, path)
    assert edges.filter("doc_id = 1").collect()[0].length == 1
    assert edges.filter("piece = 0").count() == edge_documents.count()
    assert packing.pack_documents(no_documents, path).count() == 0


def test_word_ids_equal_the_library():
    tokenizers = pytest.importorskip("tokenizers")
    path = tokenizer_path("word_bpe_49k.json")
    encoder, library = packing.WordIds(path), tokenizers.Tokenizer.from_file(path)
    rng = random.Random(5)
    letters = "abcXYZéÉßẞİΣσςΑжЖ'.,;:!?<>|_-#$%019  \x1c\x85́ﬁ你好K \n\t\0"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(1500)]
    for batch in (texts, [t.replace("<|", "") for t in texts], ["word, word. WORD!", "a-b it's 'll x's"], [""], []):
        found = encoder.encode(pa.array([t.encode() for t in batch], pa.binary()))
        expected = [library.encode(t, add_special_tokens=False).ids for t in batch]
        assert [np.frombuffer(ids, "<u4").tolist() for ids in found] == expected


def test_no_packing_beats_the_lower_bound():
    rng = np.random.default_rng(4)
    for low, high in ((1, 4097), (1300, 1500), (2049, 2100), (1, 60)):
        lengths = rng.integers(low, high, 300)
        bins = packing.best_fit(lengths)
        assert np.bincount(bins, weights=lengths).max() <= 4096
        assert packing.lower_bound(lengths) <= bins.max() + 1
    assert packing.lower_bound(np.full(10, 2049)) == 10
    assert packing.lower_bound(np.full(9, 1366)) == 5


# --- vectors ----------------------------------------------------------------------------------


def test_vectors_against_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = []
    for label in range(3):
        for _ in range(25):
            base = rng.normal(size=16)
            for _ in range(rng.integers(1, 9)):
                rows.append((label, base + rng.normal(size=16) * 0.05))
    rows += [(0, rows[0][1])] * 3
    data = [(i, v.astype(np.float32).tolist(), label) for i, (label, v) in enumerate(rows)]
    data += [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, data[0][1], None), (9004, [None] + [1.0] * 15, 0), (None, data[0][1], 0)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("node", F.lit(1))
    got = {r.vec_id: r for r in embeddings.near_duplicate_vectors(frame).collect()}
    assert len(got) == len(data)
    unit = np.array([v for _, v, _ in data[: len(rows)]], dtype=float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([x for _, _, x in data[: len(rows)]])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label)
    union = Union(range(len(rows)))
    for a, b in zip(*np.nonzero(near)):
        union.join(int(a), int(b))
    for i in range(len(rows)):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (near[i].sum() - 1, union.find(i), union.find(i) == i)
    for i in (9000, 9001, 9002, 9003, 9004):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[None].component_id is None and not got[None].kept
    assert embeddings.near_duplicate_vectors(frame.limit(0)).count() == 0


def near_pairs(vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    return {(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(unit @ unit.T >= 0.98, 1)))}


def test_shards_and_copies_lose_no_links(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(40, 12))
    vectors = np.repeat(base, 6, axis=0) + rng.normal(size=(240, 12)) * 0.03
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    nodes = embeddings.vector_nodes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))
    expected = near_pairs(vectors)
    for sizes in ((60, 50), (60, 1_000), (1_000, 50), (3, 3)):  # of a shard, of a copy's queries
        got = {tuple(r) for r in embeddings.vector_links(nodes, *sizes).collect()}
        assert got <= expected and len(got) >= 0.98 * len(expected)


def test_sparse_links_across_shards_are_all_found(spark):
    rng = np.random.default_rng(10)
    vectors = rng.normal(size=(900, 16))
    vectors[::90] = vectors[7::90] + rng.normal(size=(10, 16)) * 0.02
    rows = [(i, v.astype(np.float32).tolist(), "x") for i, v in enumerate(vectors)]
    nodes = embeddings.vector_nodes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string"))
    expected = near_pairs(vectors.astype(np.float32).astype(float))
    assert len(expected) == 10
    assert {tuple(r) for r in embeddings.vector_links(nodes, shard_rows=300).collect()} == expected


def test_an_audit_widens_the_beam_until_links_are_found():
    rng = np.random.default_rng(11)
    vectors = np.repeat(rng.normal(size=(30, 8)), 3, axis=0) + rng.normal(size=(90, 8)) * 0.01
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    graph = embeddings.Graph.build(unit.astype(np.float32))
    whole = embeddings.Searcher(graph, np.arange(90), unit)
    both = near_pairs(vectors) | {(b, a) for a, b in near_pairs(vectors)}
    assert set(whole.links(np.arange(90), unit)) == both and whole.seen == len(both)
    assert whole.width < 180
    graph.layers = [dict.fromkeys(range(90), [])]  # a graph that leads nowhere
    broken = embeddings.Searcher(graph, np.arange(90), unit)
    assert set(broken.links(np.arange(90), unit)) == both and broken.width >= 180
    alone = embeddings.Searcher(graph, np.arange(90), unit)
    assert alone.links(np.array([500]), -unit[:1]) == [] and alone.seen == 0  # nothing to judge by


def test_a_graph_is_exchanged_once_for_all_queries(spark, monkeypatch):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(np.random.default_rng(12).normal(size=(400, 8)))]
    nodes = embeddings.vector_nodes(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"))

    def arrivals(batches):  # a row per graph that a task receives, each of its own
        import uuid

        for batch in batches:
            first = [int(np.frombuffer(data, np.int64)[0]) for data in batch["nodes"].dropna()]
            yield pd.DataFrame({"a": first, "b": [1_000 + (uuid.uuid4().int >> 70) for _ in first]}, dtype=np.int64)

    monkeypatch.setattr(embeddings, "_search", arrivals)
    for copy_rows, copies in ((1_000, 1), (200, 2)):
        got = [r.a for r in embeddings.vector_links(nodes, shard_rows=100, copy_rows=copy_rows).collect()]
        assert len(set(got)) == 4 and len(got) == 4 * copies


# --- the registered queries ---------------------------------------------------------------------


def test_all_queries_are_registered():
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES


def test_pipeline_stages(spark):
    import corpus_pipeline

    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    before = docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF).cache()
        after = docs.select("doc_id").distinct().count()
        assert 0 < after <= before
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        if name == "n-gram Jaccard join":
            found = near_duplicates.near_duplicates(docs)
            assert found.filter("doc_id != component_id").count() == 0
        before = after


def test_near_duplicate_stage_keeps_one_of_repeated_rows(spark, edge_documents):
    import corpus_pipeline

    kept = corpus_pipeline.drop_near_duplicates(spark, edge_documents, SF)
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 2, 3, 4, 5, 7, 9]
    assert kept.columns == edge_documents.columns


def test_all_stages_on_edge_rows(spark, edge_documents, no_documents):
    """Each stage on all edge rows, and the chain of all five on an empty table."""
    import corpus_pipeline

    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, edge_documents, SF)
        assert kept.columns == edge_documents.columns
        assert 0 < kept.count() <= edge_documents.count()
        assert stage(spark, no_documents, SF).count() == 0
    pieces = corpus_pipeline.pack_sequences(spark, edge_documents, SF)
    assert pieces.filter("piece = 0").count() == edge_documents.count()
    docs = edge_documents
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        docs.count()
    assert docs.select("doc_id").distinct().count() >= 1


def test_two_texts_of_one_identifier_are_two_rows(spark, documents):
    import corpus_pipeline

    one, other = "alpha beta gamma delta epsilon " * 9, "one two three four five six seven " * 9
    rows = [(1, one), (1, other), (1, one), (2, one), (None, other), (None, "nobody has this text but me and no one")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], documents.schema)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", one), ("1", other), ("None", rows[-1][1])])


def test_chat_query_with_more_columns(spark, tmp_path):
    turns = read_table(spark, SF, "conversations")
    turns.withColumn("lang", F.lit("en")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op5_chat_formatting"](spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, QUERIES["op5_chat_formatting"](spark, SF).collect()))
