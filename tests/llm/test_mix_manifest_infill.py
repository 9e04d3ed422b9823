"""Mixing, manifest and infilling against plain versions: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlake.llm import infill, manifest, mixing
from marketlake.llm.common import fold
from marketlake.llm.ranks import ranked

#: Extra columns clash with names that the operators use or give back.
DOCS = "doc_id long, text string, source string, size long, copies long, n long, form string, tree string, path string, _row long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def documents(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 2, 3, "f", "t", "p", 4) for i, t, s in rows], DOCS)


@pytest.fixture(scope="module")
def rows():
    """A hot source, null and empty sources, ids and texts, repeated rows, one id with several texts, a long text."""
    rng = np.random.default_rng(5)
    hot = [(i, " ".join(["w"] * int(rng.integers(1, 40))), "hot") for i in range(300)]
    small = [(1000 + i, "A b  c" * (i % 5), f"s{i % 7}") for i in range(60)]
    odd = [
        (None, "x y", "s1"), (None, None, None), (None, "x y", "s1"), (2000, "", ""), (2001, " \n\t ", None),
        (2002, None, "empty"), (2003, "é è  ü\x0b😀 z\x00", "é"), (2004, "word " * 50000, "long"),
        (2005, "same", "s2"), (2005, "same", "s2"), (2005, "Other", "s2"), (2006, "a <P> b <M>", "Z"), (2007, "x" * 20000, "Z"),
    ]
    return hot + small + odd


# --- places ---


def test_places(spark, rows):
    df = documents(spark, rows).withColumn("g", F.coalesce("source", F.lit("-"))).repartition(7)
    got = ranked(df, "g", [F.col("doc_id").asc_nulls_first(), F.col("text")], "place", "many")
    groups = defaultdict(list)
    for i, t, s in rows:
        groups[s if s is not None else "-"].append((i is not None, i or 0, t is not None, t or ""))
    want = [(g, *v, k, len(vs)) for g, vs in groups.items() for k, v in enumerate(sorted(vs))]
    found = [
        (r["g"], r["doc_id"] is not None, r["doc_id"] or 0, r["text"] is not None, r["text"] or "", r["place"], r["many"]) for r in got.collect()
    ]
    assert sorted(found) == sorted(want) and got.columns == [*df.columns, "place", "many"]


# --- mixing ---


def plain_targets(sums, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    order = sorted(sums, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    target = dict.fromkeys(order, Fraction(0))
    left, free = share * sum(sums.values()), set(order)
    while left > 0 and free:
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] += left * weight[s] / total
        left = Fraction(0)
        for s in list(free):
            if target[s] >= most * sums[s]:
                left += target[s] - most * sums[s]
                target[s] = Fraction(most * sums[s])
                free.remove(s)
    return target


def plain_mix(rows):
    sums = Counter()
    for _, t, s in rows:
        sums[s] += len(WORD.findall(t or ""))
    target = plain_targets(sums)
    out = []
    for i, t, s in rows:
        rate = float(target[s]) / sums[s] if sums[s] else 0.0
        drawn = int(sha(":".join(["42"] + ["-" if v is None else str(v) for v in (i, s, t)]))[:13], 16) / 2**52
        out.append((i, len(WORD.findall(t or "")), sums[s], float(target[s]), int(rate) + (drawn < rate - int(rate))))
    return out


def test_mixing(spark, rows):
    docs = documents(spark, rows).repartition(5)
    got = [tuple(r) for r in mixing.repetitions(docs).collect()]
    assert sorted(got, key=repr) == sorted(plain_mix(rows), key=repr)
    assert all(r[4] <= 2 for r in got)
    mixed = mixing.mix(docs)
    assert mixed.columns == [*docs.columns, "copy"]
    want = Counter()
    for (i, t, s), (*_, n) in zip(rows, plain_mix(rows)):
        want.update((i, t, s, k + 1) for k in range(n))
    assert Counter((r["doc_id"], r["text"], r["source"], r["copy"]) for r in mixed.collect()) == want


def test_mixing_comes_near_its_targets(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 4}") for i in range(4000)]
    got = mixing.repetitions(documents(spark, rows)).select("target", (F.col("size") * F.col("copies")).alias("taken")).groupBy("target").sum("taken")
    assert all(abs(taken / target - 1) < 0.05 for target, taken in got.collect())


@settings(max_examples=8, deadline=None, phases=[Phase.explicit, Phase.generate])
@given(st.dictionaries(st.sampled_from(["a", "b", "c", "d", "e", None]), st.integers(0, 40), min_size=1))
def test_targets(spark, sums):
    sized = spark.createDataFrame(list(sums.items()), "source string, size long")
    got = {r["source"]: (r["source_size"], r["target"]) for r in mixing.targets(sized, "source", "size").collect()}
    assert got == {s: (sums[s], float(t)) for s, t in plain_targets(sums).items()}


def test_mixing_of_nothing(spark):
    none = documents(spark, [])
    assert mixing.repetitions(none).collect() == [] and mixing.mix(none).collect() == []
    one = documents(spark, [(1, None, "s")])
    assert [tuple(r) for r in mixing.repetitions(one).collect()] == [(1, 0, 0, 0.0, 0)] and mixing.mix(one).collect() == []


# --- manifest ---


def plain_tree(digests, fanout):
    """(root, path of every leaf)."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for leaf, k in enumerate(at):
            first = k // fanout * fanout
            paths[leaf].append(("".join(level[first:k]), "".join(level[k + 1 : first + fanout])))
        level = [sha("".join(level[k : k + fanout])) for k in range(0, len(level), fanout)]
        at = [k // fanout for k in at]
    return level[0], paths


def plain_manifest(rows, fanout):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    groups = defaultdict(list)
    for i, t, s in rows:
        groups[s].append((i is not None, i or 0, sha(enc(i) + enc(s) + enc(t)), t))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([r[2] for r in sorted(groups[s], key=lambda r: r[:3])], fanout) for s in order}
    root, above = plain_tree([trees[s][0] for s in order], fanout)
    out = []
    for s, top in zip(order, above):
        for (known, i, leaf, t), path in zip(sorted(groups[s], key=lambda r: r[:3]), trees[s][1]):
            steps, now = path + top, leaf
            if known and i % 3 == 0 and t is not None:
                now = sha(enc(i) + enc(s) + enc(t.lower()))
            for left, right in steps:
                now = sha(left + now + right)
            proof = sha("".join(a + b for a, b in steps))
            out.append((i if known else None, leaf, trees[s][0], root, proof, now, now == root))
    return out


@pytest.mark.parametrize("fanout", [2, 3, 16])
def test_manifest(spark, rows, fanout):
    docs = documents(spark, rows)
    leaf = manifest.leaf_of(*[F.col(c) for c in ("doc_id", "source", "text")])
    lowered = manifest.leaf_of(F.col("doc_id"), F.col("source"), F.lower("text"))
    docs = docs.withColumns({"leaf": leaf, "digest": F.when(F.col("doc_id") % 3 == 0, lowered)}).repartition(6)
    built = manifest.build(docs, "leaf", "source", "doc_id", carry=["digest"], fanout=fanout)
    got = [tuple(r) for r in manifest.verified_rows(built).drop("_c0").collect()]
    assert sorted(got, key=repr) == sorted(plain_manifest(rows, fanout), key=repr)
    # nodes of a level cover a tree's leaves without gaps or overlaps
    covered = defaultdict(list)
    for r in built.forest.nodes().collect():
        covered[r["tree"], r["level"]].append((r["lo"], r["hi"]))
    for spans in covered.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))


def test_manifest_of_one_row_and_of_none(spark):
    leaves = spark.createDataFrame([(1, "s", "d")], "id long, source string, leaf string")
    built = manifest.build(leaves.withColumn("now", F.lit(None).cast("string")), "leaf", "source", "id", ["now"])
    assert [tuple(r) for r in manifest.verified_rows(built).drop("_c0").collect()] == [(1, "d", "d", "d", sha(""), "d", True)]
    none = manifest.build(leaves.filter("false").withColumn("now", F.col("leaf")), "leaf", "source", "id", ["now"])
    assert none.root is None and manifest.verified_rows(none).collect() == [] and none.forest.nodes().collect() == []


# --- infilling ---

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_cuts(texts, low, high):
    out = []
    for t, a, b in zip(texts, low, high):
        units = UNIT.findall(t)
        k = sorted((a % (len(units) + 1), b % (len(units) + 1)))
        out.append((len(units), *(len("".join(units[:c]).encode()) for c in k)))
    return out


TEXTS = st.text(alphabet=" \t\n\x0b\x1f\x0e\x08\x00ab€é😀\x89\xa0 \u0085", max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(TEXTS, st.integers(0, 2**32 - 1), st.integers(0, 2**32 - 1)), max_size=12))
def test_cut_points(items):
    texts, low, high = zip(*items) if items else ((), (), ())
    body = b"pad" + "".join(texts).encode()
    offsets = 3 + np.cumsum([0] + [len(t.encode()) for t in texts])
    got = infill.cut_points(np.frombuffer(body, np.uint8), offsets, (np.array(low, np.int64), np.array(high, np.int64)))
    assert list(zip(*map(list, got))) == plain_cuts(texts, low, high)


def test_white_bytes_in_every_place():
    every = np.arange(256, dtype=np.uint8)
    for shift in range(8):
        words = np.roll(np.resize(every, 2048), shift).view("<u8")
        flags = infill.white(words).view(np.uint8)
        assert ((flags == 0x80) == np.isin(words.view(np.uint8), [0x20, *range(9, 14)])).all() and set(flags) <= {0, 0x80}


def plain_infill(i, text, rate=50):
    text = text or ""
    h = sha(f"42:{'' if i is None else i}")
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return i, len(units), "plain", None, None, text, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 80
    return i, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}", text


@pytest.mark.parametrize("rate, size", [(50, 8 << 20), (100, 64)])
def test_infill(spark, rows, rate, size, monkeypatch):
    monkeypatch.setattr(infill, "SLICE", size)
    more = rows + [(3000 + k, "< P> a<S b >M> <", "s") for k in range(9)]
    made = infill.transform(documents(spark, more).repartition(3), rate=rate)
    assert made.columns == [c for c in DOCS.replace(",", "").split()[::2] if c not in ("n", "form")] + ["n", "form", "prefix_chars", "middle_chars", "output"]
    got = made.withColumn("back", infill.restored("output", "form"))
    got = [tuple(r) for r in got.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "back").collect()]
    want = [plain_infill(i, t, rate) for i, t, _ in more]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert rate == 50 or {w[2] for w in want} == {"plain", "psm", "spm"}


def test_infill_of_nothing(spark):
    assert infill.transform(documents(spark, [])).collect() == []


def test_tampering_is_found(spark):
    """Through the query: exactly the tampered texts with capital letters fail."""
    from marketlake.llm import queries
    from marketlake.llm.common import read

    folder = "/root/testdata/sf0.001"
    capitals = F.col("text").rlike("[A-Z]") & (fold("doc_id", 5) == 0)
    want = {r[0] for r in read(spark, folder, "documents").filter(capitals).select("doc_id").collect()}
    got = queries.QUERIES["op12_manifest"](spark, folder)
    assert {r["doc_id"] for r in got.collect() if not r["verified"]} == want and want
