"""The prefix trie, exact clustering and mixing against plain computations."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillroll.llm import centroids, mixing, numbering, prefix_trie
from tillroll.llm.common import read_table
from tillroll.llm.queries import ORACLES, QUERIES

from .conftest import SF, with_clashes

TURN = "conv_id long, turn int, role string, text string"


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def equals_oracle(spark, name, *tables):
    database = duckdb.connect()
    for table in tables:
        database.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    expected = database.sql(ORACLES[name])
    frame = QUERIES[name](spark, SF)
    assert sorted(frame.columns) == sorted(expected.columns)
    got = Counter(tuple(r) for r in frame.select(sorted(frame.columns)).collect())
    order = [expected.columns.index(c) for c in sorted(expected.columns)]
    assert got == Counter(tuple(r[i] for i in order) for r in expected.fetchall())
    assert got


# --- numbering --------------------------------------------------------------------------


def test_numbers_of_a_hot_group(spark):
    rng = random.Random(3)
    rows = [(None if g == 9 else min(g, 3), rng.randrange(50)) for g in (rng.choice([0, 0, 0, 1, 2, 3, 9]) for _ in range(5_000))]
    frame = spark.createDataFrame(rows, "g int, x int")
    got = defaultdict(list)
    for r in numbering.numbered(frame, "g", [F.col("x").desc()], "place", "numbers").collect():
        got[r.g].append((r.place, r.x))
    expected = defaultdict(list)
    for g, x in rows:
        expected[g].append(x)
    assert got.keys() == expected.keys()
    for g, found in got.items():
        assert sorted(found) == list(enumerate(sorted(expected[g], reverse=True)))


# --- the trie ---------------------------------------------------------------------------


def brute_trie(rows):
    """Nodes of the rebuilt conversations by walking dictionaries."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn, role or "", text or ""))
    said = {c: [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0))] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        rebuilt[c] = said.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]  # % as in SQL
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    nodes = {}
    for path in sorted(members, key=len, reverse=True):
        inside = members[path]
        below = [p for p in nodes if len(p) == len(path) + 1 and p[:-1] == path]
        ends = sorted(c for c in inside if len(rebuilt[c]) == len(path))
        nodes[path] = {
            "row": (min(inside), len(path), min(members[path[:-1]]) if path else None, len(inside), len(below)),
            "leaves": sum(nodes[p]["leaves"] for p in below) or 1,
            "saved": sum(nodes[p]["saved"] for p in below) + ((len(inside) - 1) * len(path[-1][1]) if path else 0),
            "sha": hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
        }
    return Counter((*n["row"], n["leaves"], n["saved"], n["sha"]) for n in nodes.values())


def conversations():
    """Shared openings, exact copies, prefixes of others, turnless rebuilds and long conversations."""
    rng = random.Random(17)
    text = lambda: rng.choice(["ja", "nein", "", "vielleicht 😀", "ok", None])
    rows = []
    long = [(("user", "assistant")[i % 2], f"turn {i}") for i in range(700)]
    for c in list(range(0, 40)) + list(range(100, 130)) + [250, 399, 4_100, 4_101, 9_000, -5]:
        n = rng.choice([1, 2, 3, 6, 9, 17])
        for t in range(n):
            rows.append((c, t, rng.choice(["user", "assistant", None]), text()))
    for c, n in ((501, 699), (502, 699), (503, 80), (504, 64), (505, 65), (12_345, 699), (500, 4)):
        rows += [(c, t, *turn) for t, turn in enumerate(long[:n])]
    rows += [(506, t, *turn) for t, turn in enumerate(long[:300] + [("user", "other")] + long[:90])]
    rows += [(77_777, None, "user", "first"), (77_777, 3, "user", "last"), (77_777, 1, None, None)]
    rows.append((None, 0, "user", "nobody's"))
    rng.shuffle(rows)
    return rows


def test_trie_equals_brute_force(spark):
    rows = conversations()
    got = rows_of(prefix_trie.digested_trie(with_clashes(spark.createDataFrame(rows, TURN))))
    assert got == brute_trie(rows)


def test_chunks_of_ends_are_hashed_in_order(spark):
    """More copies than one row of endings holds, with equal digests from one pass over all."""
    ids = list(range(3, 9_000, 2)) + [10**12]
    frame = spark.createDataFrame([(0, b"", i) for i in ids], "depth long, name binary, conv_id long")
    (row,) = prefix_trie.end_digests(frame).collect()
    assert row.ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_trie_edge_tables(spark):
    empty = spark.createDataFrame([], TURN)
    assert prefix_trie.digested_trie(empty).count() == 0
    nameless = spark.createDataFrame([(None, 1, "user", "x")], TURN)
    assert prefix_trie.digested_trie(nameless).count() == 0
    # Conversation 250 hides its only turn behind an opening that is not there: a root alone.
    assert zlib.crc32(b"250") % 6 > 0
    alone = spark.createDataFrame([(250, 0, "user", "x")], TURN)
    none = hashlib.sha256(b"250").hexdigest()
    assert rows_of(prefix_trie.digested_trie(alone)) == Counter([(250, 0, None, 1, 0, 1, 0, none)])


def test_trie_equals_sql(spark):
    equals_oracle(spark, "op11_prefix_trie", "conversations")


# --- clustering -------------------------------------------------------------------------


def brute_clusters(rows, k=16, rounds=3):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(64 * float(np.float32(x)))) for x in v]))
    digest = lambda i: (i is None, "" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest())
    centres = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[assign(v)[1]].append(v)
        for j, vectors in groups.items():
            centres[j] = [sum(column) // len(vectors) for column in zip(*vectors)]
    found = [(i, *assign(v)) for i, v in kept]
    inside = Counter()
    for _, d, j in found:
        inside[j] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return Counter((i, j, d, inside[j], sum(inside.values()), sha[j]) for i, d, j in found)


def vectors(n):
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(0, 0.2, 64)]) for i in range(n)]
    whole = rows[0][1]
    odd = [
        (1_000, None),
        (1_001, []),
        (1_002, whole[:63]),
        (1_003, whole + [0.0]),
        (1_004, whole[:63] + [None]),
        (1_005, whole[:63] + [float("nan")]),
        (1_006, whole[:63] + [float("-inf")]),
        (1_007, [0.0] * 64),
        (1_008, [1000.5] * 64),
        (None, whole),
        (3, whole),
        (3, whole),
    ]
    return rows + odd


@pytest.mark.parametrize("n", [150, 7, 1])
def test_clusters_equal_brute_force(spark, n):
    rows = vectors(n) if n > 1 else [(4, [0.5] * 64)]
    frame = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).repartition(3)
    assert rows_of(centroids.cluster_vectors(frame)) == brute_clusters(rows)


def test_clusters_edge_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert centroids.cluster_vectors(empty).count() == 0
    short = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<float>")
    assert centroids.cluster_vectors(short).count() == 0
    large = spark.createDataFrame([(1, [1e30] * 64), (2, [0.0] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="would not fit 64 bits"):
        centroids.cluster_vectors(large).count()


def test_pages_lose_nothing():
    rng = np.random.default_rng(2)
    whole = rng.integers(-9, 9, (700, 7))
    page = centroids.Page.encode(whole)
    assert (page.decode() == whole).all()
    centres = rng.integers(-9, 9, (5, 7))
    apart = ((whole[:, None, :] - centres[None]) ** 2).sum(axis=2)
    cluster, distance = page.nearest(centres)
    assert (cluster == apart.argmin(axis=1)).all() and (distance == apart.min(axis=1)).all()
    assert (page.sums(cluster, 5) == [whole[cluster == j].sum(axis=0) for j in range(5)]).all()


def test_clusters_equal_sql(spark):
    equals_oracle(spark, "op12_centroid_clustering", "embeddings")


# --- mixing -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(3, 1, 2)):
    """Water filling in exact fractions: full sources leave, the rest is divided again."""
    named = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(named)}
    left, open_sources, target = Fraction(3, 2) * sum(sizes.values()), set(named), {}
    while open_sources:
        per = left / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if per * weight[s] >= 2 * sizes[s]}
        if not full:
            return target | {s: per * weight[s] for s in open_sources}
        for s in full:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
        open_sources -= full
    return target


def check_mix(rows, docs, nearness):
    """Targets are the plain ones, each row is there, and each source comes within `nearness` words."""
    n_words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, source, text in docs:
        sizes[source] += n_words(text)
    target = plain_targets(sizes)
    source_of = {i: source for i, source, _ in docs}
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, n_words(t)) for i, _, t in docs)
    taken, longest = Counter(), Counter()
    for r in rows:
        source = source_of[r.doc_id]
        assert r.source_size == sizes[source]
        assert r.target == pytest.approx(float(target[source]), rel=1e-9)
        share = r.target / r.source_size if r.source_size else 0
        assert r.taken in {int(share) * r["size"], int(share) * r["size"] + r["size"]}
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source] += r.taken
        longest[source] = max(longest[source], r["size"])
    for source in sizes:
        assert abs(taken[source] - target[source]) <= nearness(longest[source], sizes[source]) + 1e-6


def test_mix_of_the_given_documents(spark, documents):
    rows = mixing.mix_sources(documents).collect()
    docs = [(r.doc_id, r.source, r.text) for r in documents.collect()]
    check_mix(rows, docs, lambda longest, size: longest / 2)


def test_mix_is_near_with_many_documents(spark):
    """One source with a third of all rows, one very long document in each, several levels."""
    rng = random.Random(23)
    docs = []
    for i in range(9_000):
        source = rng.choice(["hot", "hot", "hot", "hot", None, "ö", "a", "B", "😀", "zz", "b", "c"])
        docs.append((i, source, "w " * int(rng.lognormvariate(3, 1))))
    docs += [(10_000 + i, s, "w\t" * 20_000) for i, s in enumerate(["hot", None, "a"])]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string").repartition(7)
    rows = mixing.mix_sources(frame).collect()
    check_mix(rows, docs, lambda longest, size: 0.01 * size)
    again = mixing.mix_sources(frame.repartition(3)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_keeps_expectations(spark):
    """Over many sources of the same documents, each length is taken as often as its source's share says."""
    lengths = [1, 2, 3, 5, 8, 13, 40]
    docs = [(s * 100 + i, f"s{s:04}", "w " * n) for s in range(900) for i, n in enumerate(lengths)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string")
    often, chance = Counter(), Counter()
    for r in mixing.mix_sources(frame).collect():
        often[r["size"]] += r.taken / r["size"]
        chance[r["size"]] += r.target / r.source_size
    # The last document of a source goes to its nearer end, which is no draw.
    assert all(abs(often[n] - chance[n]) < 90 for n in lengths), (often, chance)


def test_mix_of_edge_rows(spark, edge_documents, no_documents):
    rows = mixing.mix_sources(edge_documents).collect()
    assert len(rows) == edge_documents.count()
    assert all(0 <= r.taken <= 2 * r["size"] and r.target >= 0 for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix_sources(no_documents).count() == 0
    blank = spark.createDataFrame([(1, "a", None), (2, None, " ")], "doc_id long, source string, text string")
    assert {tuple(r) for r in mixing.mix_sources(blank).collect()} == {(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)}


def test_mixing_runs_no_python(spark, documents):
    plan = mixing.mix_sources(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
