"""Every operator against a plain version on small rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from marketlake.llm import (
    components,
    contamination,
    language,
    licences,
    packing,
    scoring,
    simhash,
    suffixes,
    toxicity,
    urls,
    vectors,
)
from marketlake.llm.common import ascii_words, spaced_words, stars

DOCS = "doc_id long, text string, lang string, source string, fp long, id long, node long"
RNG = np.random.default_rng(1)
SYLLABLES = ["ka", "ro", "mi", "te", "su", "no", "la", "vi", "ed", "on"]


def prose(n, seed=None):
    rng = np.random.default_rng(seed) if seed is not None else RNG
    return " ".join("".join(rng.choice(SYLLABLES, rng.integers(1, 4))) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 1, 2, 3) for i, t, lang in rows], DOCS)


@pytest.fixture(scope="module")
def odd():
    """Ids and texts with every odd case; copies, near copies and a shared passage among them."""
    base, passage = prose(120, 3), prose(30, 4)
    rows = [
        (1, base, "aa"),
        (2, base, None),
        (3, base + " tail", "aa"),
        (4, None, "aa"),
        (5, "", None),
        (6, " \n\t ", "bb"),
        (7, prose(20, 5) + " " + passage + " " + prose(20, 6), "bb"),
        (8, prose(20, 7) + " " + passage + " " + prose(20, 8), "bb"),
        (9, "à" * 150 + passage, "aa"),
        (9, "à" * 150 + passage, "aa"),
        (10, "ab " * 4000, "aa"),
        (11, prose(6000, 9), "bb"),
        (12, "<|endoftext|> it's  we'll\n\nso \x00 x", None),
        (13, passage, "aa"),
    ]
    return rows


# --- components ---


def test_components_match_union(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, (50, 2))] + [(100 + i, 101 + i) for i in range(30)] + [(7, 200 + i) for i in range(50)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in linked} and len(got) == len(linked)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_stars_span_components():
    nodes, roots = stars(np.array([5, 4, 9, 3]), np.array([4, 3, 8, 3]))
    assert dict(zip(nodes.tolist(), roots.tolist())) == {5: 3, 4: 3, 9: 8}


# --- SimHash ---


def plain_fingerprint(text, shingle=3):
    import xxhash

    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if parts else 0


def plain_groups(ids, near):
    label = {i: i for i in range(len(ids))}
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if near(i, j) and label[j] < label[i]:
                    label[i], changed = label[j], True
    return [min(ids[k] for k in label if label[k] == label[i]) for i in range(len(ids))]


def test_simhash(spark, odd):
    got = sorted(tuple(r) for r in simhash.near_duplicates(documents(spark, odd)).collect())
    codes = [plain_fingerprint(t) for _, t, _ in odd]
    ids = [i for i, _, _ in odd]
    groups = plain_groups(ids, lambda i, j: (codes[i] ^ codes[j]).bit_count() <= 3)
    assert got == sorted(zip(ids, (f"{c:016x}" for c in codes), groups))


def test_simhash_keeps_one_row_of_each_group(spark, odd):
    docs = documents(spark, odd + [(None, "lonely words of no id", "aa"), (None, "other words without an id here", "aa")])
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    groups = simhash.near_duplicates(docs).collect()
    firsts = {r["component_id"] for r in groups} - {None}
    assert sorted(i for i, _ in found if i is not None) == sorted(firsts)
    assert sum(i is None for i, _ in found) == 2
    assert simhash.keep_one(docs.limit(0)).collect() == []


def test_gray_search_is_exact_over_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 2**63, 40, dtype=np.uint64)
    codes = np.unique(np.concatenate([seeds ^ (np.uint64(1) << np.uint64(b)) for b in rng.integers(0, 64, 12)] + [seeds]))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    frame = spark.createDataFrame([(int(c.view(np.int64)),) for c in codes], "fp long")
    got = components.connected_components(simhash.links(frame, 3)).collect()
    signed = codes.view(np.int64).tolist()
    want = plain_groups(signed, lambda i, j: int(codes[i] ^ codes[j]).bit_count() <= 3)
    by_node = {r["node"]: r["component"] for r in got}
    assert [by_node.get(x, x) for x in signed] == want


def test_gray_search_pairs():
    rng = np.random.default_rng(6)
    codes = rng.integers(0, 1 << 16, 900, dtype=np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes), kind="stable")]
    found = set()
    for i, j in simhash.search(codes[:70], codes, 3):
        found |= set(zip(i.tolist(), j.tolist()))
    near = np.bitwise_count(codes[:70, None] ^ codes[None]) <= 3
    assert found == set(zip(*(x.tolist() for x in np.nonzero(near))))


# --- repeated strings ---


def plain_repeats(rows, length=100):
    parts, seen, out = {}, {}, {}
    for i, text in rows:
        parts.setdefault(2**63 if i is None else i, {})[hashlib.md5((text or "").encode()).hexdigest()] = (text or "").encode()
    for i in sorted(parts):
        for tag, body in sorted(parts[i].items()):
            gone = bytearray(len(body))
            for s in range(len(body) - length + 1):
                string = body[s : s + length]
                if string in seen:
                    gone[s : s + length] = b"\1" * length
                seen.setdefault(string, 1)
            kept = bytes(b for b, g in zip(body, gone) if not g)
            spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
            out[i, tag] = (len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return sorted(((i, *out[2**63 if i is None else i, hashlib.md5((t or "").encode()).hexdigest()]) for i, t in rows), key=repr)


@pytest.mark.parametrize("group", [2, 65_536])
def test_repeats(spark, odd, group, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", group)
    rows = [(i, t) for i, t, _ in odd] + [(None, odd[6][1]), (None, "short"), (7, odd[0][1] + "!"), (14, odd[6][1][5:] * 3)]
    got = suffixes.repeat_digests(documents(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_repeats(rows)


def test_repeats_of_many_texts_of_an_id(spark, monkeypatch):
    """What is gathered for a row is bounded by its own text, not by the texts that share its id."""
    passage = prose(30, 4)
    rows = [(i, f"{prose(8, 100 + k)} {passage} {prose(8, 300 + k)}") for k in range(60) for i in (None, 5)] + [(None, None)] * 40
    finish = suffixes._finish

    def spy(text, names, *others):
        run = finish(text, names, *others)

        def checked(batches):
            for batch in batches:
                for c in names[-3:]:
                    assert max(len(v or []) for v in batch.column(c).to_pylist()) <= 20
                yield from run(iter([batch]))

        return checked

    monkeypatch.setattr(suffixes, "_finish", spy)
    got = suffixes.repeat_digests(documents(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted((tuple(r) for r in got), key=repr) == plain_repeats(rows)


def test_repeats_keep_columns_and_characters(spark, odd):
    docs = documents(spark, odd)
    got = suffixes.without_repeats(docs)
    assert got.columns == docs.columns and got.count() == len(odd)
    texts = {r["doc_id"]: r["text"] for r in got.collect()}
    assert texts[2] == "" and texts[1] == odd[0][1] and texts[4] == "" and len(texts[8]) < len(odd[7][1])
    assert suffixes.without_repeats(docs.limit(0)).collect() == []


def test_kept_text_drops_whole_characters():
    body = "aéb".encode()
    assert suffixes.kept_text(body, [(0, 2)]) == "b" and suffixes.kept_text(body, [(2, 4)]) == "a" and suffixes.kept_text(body, []) == "aéb"


def test_prefix_intervals():
    # lcp array of the sorted suffixes of "banana"
    assert sorted(suffixes.intervals([1, 3, 0, 0, 2], 1)) == [(0, 2, 1), (1, 2, 3), (4, 5, 2)]


# --- decontamination ---


def test_leaks(spark, odd):
    passage = odd[-1][1]
    items = [(1, passage), (2, prose(40, 77)), (3, None), (4, "a b"), (5, passage.upper() + "!"), (6, prose(6000, 9)), (7, odd[0][1])]
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    docs = documents(spark, odd)

    def shingles(text):
        return contamination.shingle_set(ascii_words((text or "").encode()))

    want = []
    for d, text, _ in odd:
        for i, item in items:
            own, both = shingles(item), shingles(item) & shingles(text)
            if own and len(both) >= 0.8 * len(own):
                want.append((d, i, len(own), len(both), len(both) / len(own)))
    got = sorted(tuple(r) for r in contamination.leaks(docs, frame).collect())
    assert got == sorted(want) and len(want) > 4
    clean = contamination.without_leaks(docs, frame)
    leaked = {w[0] for w in want}
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _, _ in odd if d not in leaked)
    assert contamination.without_leaks(docs, frame.limit(0)).count() == len(odd)
    assert contamination.leaks(docs.limit(0), frame).collect() == []


def test_leaks_in_blocks_of_items(spark, odd, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_ITEMS", 1)
    frame = spark.createDataFrame([(1, odd[-1][1]), (2, odd[0][1])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.leaks(documents(spark, odd), frame).collect()}
    assert {(7, 1), (8, 1), (13, 1), (1, 2), (2, 2), (3, 2)} <= got


def test_word_hashes_agree_with_words():
    for text in (b"", b"  ", b"a", b"A b,c 12 " * 20_000, b"x" * 200_000 + b" y", "é ü-z".encode()):
        words = ascii_words(text)
        hashes = contamination.word_hashes(text)
        assert len(hashes) == len(words)
        assert len(set(hashes.tolist())) == len(set(words))


# --- packing ---


def test_pack(spark, odd):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_vocabulary())
    got = packing.pack(documents(spark, odd)).collect()
    want = Counter()
    for i, text, _ in odd:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)] if len(ids) > 1024 else [0, len(ids)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter(tuple(r)[:5] for r in got) == want
    by_sequence = {}
    for r in got:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(documents(spark, odd).limit(0)).collect() == []


def test_sequences_hold_the_ids(spark, odd):
    rows = packing.sequences(documents(spark, odd)).collect()
    placed = packing.pack(documents(spark, odd)).agg(F.sum("length")).first()[0]
    assert sum(len(r["ids"]) for r in rows) == placed and max(r["length"] for r in rows) <= 1024


def test_sum_of_squares_is_near_the_bound():
    lengths = np.sort(np.random.default_rng(0).integers(1, 1024, 20_000))[::-1]
    where, offsets = packing.sum_of_squares(lengths)
    fill = np.bincount(where, lengths)
    assert fill.max() <= 1024 and len(fill) <= 1.005 * math.ceil(lengths.sum() / 1024)
    assert packing.sum_of_squares(np.array([3, 3, 2, 1, 1]), 5)[0].max() == 1


# --- licenses ---


def test_licenses(spark):
    texts = [
        "Released under the terms of the MIT License.",
        "released under mit licenses",
        "Licensed under the Apache License, Version 2.0, the License",
        "mit mit license mit license",
        "This is licensed under the GNU General Public License, version 3.",
        "licensed under the terms of the GNU Lesser General Public License as published by the free software foundation, either version 2",
        None,
        "",
    ]
    rows = {r["doc_id"]: r for r in licences.scan(documents(spark, [(i, t, None) for i, t in enumerate(texts)])).collect()}
    assert [rows[i]["labels"] for i in range(8)] == ["mit,mit-notice", "", "apache,apache-2.0", "mit", "gpl,gpl-notice", "gpl,gpl-notice", "", ""]
    assert (rows[3]["n_base"], rows[3]["first_word"], rows[3]["last_word"], rows[3]["score"]) == (2, 1, 3, 0.5)
    assert (rows[6]["n_words"], rows[6]["first_word"], rows[6]["score"]) == (0, None, 0.0)


def license_text(template, fill="Some Holder"):
    """A text that the template accepts: with all optional words, one name in each replaceable region."""

    def words(items):
        for item in items:
            if isinstance(item, list):
                yield from words(item)
            else:
                yield (fill if item > 1 else "1.") if isinstance(item, int) else item

    return list(words(licences.parse(template)))


WHOLE = [label for label in licences.TEMPLATES if label.endswith(("-text", "-header"))]


@pytest.mark.parametrize("label", WHOLE)
def test_one_mandatory_word_decides(label):
    scanner = licences.Scanner(licences.TEMPLATES, licences.BASE)
    words = license_text(licences.TEMPLATES[label])

    def labels(some):
        return set(scanner.scan(("Preface. " + ", ".join(some).upper() + "\nmore").encode())[3])

    assert label in labels(words)
    mandatory = licences.parse(licences.TEMPLATES[label])
    plain = [i for i, w in enumerate(words) if w in mandatory]
    assert len(plain) > 20
    for i in plain[3:-1:5]:
        assert label not in labels([*words[:i], "otherwise-worded", *words[i + 1 :]])
        if words[i] not in (words[i - 1], words[i + 1]):
            assert label not in labels([*words[:i], *words[i + 1 :]])
    assert label not in labels(words[: len(words) // 2])


def test_license_scan_edges(spark):
    text = " ".join(license_text(licences.TEMPLATES["mit-text"]))
    rows = [(1, text, 3), (1, text, 4), (2, "word " * 200_000 + text, 5), (None, "MIT license", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    got = licences.scan(docs)
    seen = sorted(((r["doc_id"] or 0, r["labels"], r["score"]) for r in got.collect()))
    assert seen == [(0, "mit", 0.5), (1, "mit-text", 1.0), (1, "mit-text", 1.0), (2, "mit-text", 1.0)]
    assert licences.scan(docs.limit(0)).collect() == [] and got.columns[:2] == ["doc_id", "n_words"]


@pytest.mark.parametrize("label", list(licences.TEMPLATES))
def test_automaton_agrees_with_pattern(label):
    import re

    automaton, pattern = licences.compile_template(licences.TEMPLATES[label]), re.compile(licences.pattern(licences.TEMPLATES[label]))
    words = sorted({w for t in licences.TEMPLATES.values() for w in re.findall(r"[a-z0-9]+", re.sub("<<[^>]*>>", " ", t))} | {"zz"})
    rng = np.random.default_rng(3)

    def sample(items):
        for item in items:
            if isinstance(item, list):
                if rng.random() < 0.5:
                    yield from sample(item)
            elif isinstance(item, int):
                yield from rng.choice(words, rng.integers(0, item + 2)).tolist()
            else:
                yield item if rng.random() > 0.01 else "zz"

    for _ in range(200):
        text = [str(w) for w in sample(licences.parse(licences.TEMPLATES[label]))]
        accepted = automaton.end([w.encode() for w in text], 0) is not None
        assert accepted == bool(pattern.match("".join(w + " " for w in text)))


# --- URL filter ---


def test_urls(spark, monkeypatch):
    rules = [urls.Rule("allow", "com", "/"), urls.Rule("block", "bad.com", "/x/")]
    rows = [
        (1, "https://WWW.Bad.com/x/1?b=2&a=1&utm_q=3#f"),
        (2, "http://notbad.com/x/1"),
        (3, "http://listed.org/p/?b=2&a=1"),
        (4, "http://www.listed.org/p?a=1&b=2#z"),
        (5, None),
        (6, "no scheme"),
        (7, "x://"),
        (8, "http://other.org"),
        (8, "http://other.org"),
        (9, "http://sub.bad.com/x/"),
    ]
    pages = spark.createDataFrame([(i, u, "h", True, 1) for i, u in rows], "page_id long, url string, host string, listed boolean, w0 int")
    listed = spark.createDataFrame([("https://listed.org/p?a=1&b=2",), (None,)], "url string")
    got = urls.judge(pages, rules, listed)
    found = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["listed"], r["verdict"]) for r in got.collect() if r["page_id"])
    assert found == [
        (1, "www.bad.com", "/x/1", "bad.com/x/", False, "block"),
        (2, "notbad.com", "/x/1", "com/", False, "allow"),
        (3, "listed.org", "/p/", None, True, "block"),
        (4, "www.listed.org", "/p", None, True, "block"),
        (5, "", "", None, False, "allow"),
        (6, "", "", None, False, "allow"),
        (7, "", "", None, False, "allow"),
        (8, "other.org", "", None, False, "allow"),
        (8, "other.org", "", None, False, "allow"),
        (9, "sub.bad.com", "/x/", "bad.com/x/", False, "block"),
    ]
    assert urls.judge(pages, rules, listed.limit(0)).filter("listed").count() == 0
    # a filter that is too large to be broadcast is joined by block
    monkeypatch.setattr(urls, "MOST_BLOCKS", 0)
    assert sorted(map(tuple, urls.judge(pages, rules, listed).collect()), key=repr) == sorted(map(tuple, got.collect()), key=repr)
    assert urls.judge(pages.limit(0), rules, listed).collect() == []


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("canonical_url"))
    bits, blocks = urls.bloom_filter(keys, "canonical_url", 5000)
    probe = spark.range(20_000).select(F.concat(F.lit("u"), "id").alias("k"), (F.col("id") < 5000).alias("known"))
    hit = F.lit(True)
    for j, mask in enumerate(urls._bits(F.col("k"))):
        hit = hit & (F.col(f"w{j}").bitwiseAND(mask) == mask)
    out = probe.withColumn("block", urls._block(F.col("k"), blocks)).join(bits, "block", "left").withColumn("hit", F.coalesce(hit, F.lit(False)))
    counts = {(r["known"], r["hit"]): r["count"] for r in out.groupBy("known", "hit").count().collect()}
    assert counts[True, True] == 5000 and counts.get((False, True), 0) < 300


# --- classifiers ---


def test_toxicity(spark):
    rng = np.random.default_rng(5)
    rows = [(i, prose(int(rng.integers(5, 400)), i) + (" gruxom " if i % 5 == 2 else "") + prose(5, i + 999), None) for i in range(300)]
    rows += [(300, None, None), (301, "", None), (302, "gruxom", None), (302, "gruxom", None)]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 5 == 2)) for i in range(300)] + [(1, None), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, toxicity.training_rows())
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(score[i] >= 0.5) == (i % 5 == 2) for i in held]) > 0.97
    assert 0 <= score[300] == score[301] < 0.5
    clean = toxicity.keep_clean(docs, model)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i in score if score[i] < 0.5}
    none = toxicity.train(docs, labels.limit(0), toxicity.training_rows())
    assert toxicity.score(docs, none).filter("predicted = 1").count() == 0
    assert toxicity.score(docs.limit(0), model).collect() == []


def test_language(spark):
    letters = {"aa": "abcde", "bb": "vwxyzé"}
    rng = np.random.default_rng(8)

    def text(lang, n):
        return " ".join("".join(rng.choice(list(letters[lang]), 5)) for _ in range(n))

    rows = [(i, text(lang := "aa" if i % 2 else "bb", int(rng.integers(3, 60))), lang) for i in range(240)]
    rows += [(500, None, "aa"), (501, "", "aa"), (502, "12 !!", None), (503, text("aa", 4000), None), (503, text("bb", 9), None)]
    docs = documents(spark, rows)
    model = language.train(docs, language.training_rows())
    got = language.predict(docs, model).collect()
    assert len(got) == len(rows)
    held = [(r["lang_pred"], "aa" if r["doc_id"] % 2 else "bb") for r in got if r["doc_id"] < 240 and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert np.mean([a == b for a, b in held]) > 0.97
    assert {(r["doc_id"], r["lang_pred"], r["score"], r["accepted"]) for r in got if 500 <= r["doc_id"] <= 502} == {(i, "und", 0.0, False) for i in (500, 501, 502)}
    assert all(0 <= r["score"] <= 1 for r in got)
    nothing = language.train(docs.limit(0), language.training_rows())
    assert {r["lang_pred"] for r in language.predict(docs, nothing).collect()} == {"und"}


# --- embeddings ---


@pytest.mark.parametrize("chunk", [8, 2048])
def test_vectors(spark, chunk, monkeypatch):
    monkeypatch.setattr(vectors, "CHUNK", chunk)
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(25, 16))
    rows = [(i, (centres[i % 25] + rng.normal(size=16) * (0.02 + 0.06 * (i % 3))).tolist(), int(i % 2)) for i in range(200)]
    rows += [(200 + i, centres[0].tolist(), 0) for i in range(30)]
    rows += [(300, None, 0), (301, [0.0] * 16, 0), (302, [float("nan")] + [1.0] * 15, 0), (303, [None] + [1.0] * 15, 0), (304, centres[0].tolist(), None)]
    rows += [(305, [1e200] * 16, 0), (306, [1e-200] * 16, 0), (307, [1.0], 0), (308, [], 0), (309, [float("inf")] * 16, 0)]
    frame = spark.createDataFrame([(i, v, l, 1) for i, v, l in rows], "vec_id long, embedding array<double>, label int, node int")

    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        a = np.array(v) / np.abs(v).max()
        return a / np.sqrt((a**2).sum())

    units = [unit(v) for _, v, _ in rows]

    def near(i, j):
        a, b = units[i], units[j]
        return i != j and rows[i][2] is not None and rows[i][2] == rows[j][2] and a is not None and b is not None and len(a) == len(b) and float(a @ b) >= 0.98

    ids = [r[0] for r in rows]
    groups = plain_groups(ids, near)
    want = sorted((ids[i], sum(near(i, j) for j in range(len(rows))), groups[i], groups[i] == ids[i]) for i in range(len(rows)))
    # a square of 1e200 is not finite: scaled vectors are compared, so both extremes link
    assert sorted(tuple(r) for r in vectors.near_duplicates(frame).collect()) == want
    assert vectors.near_duplicates(frame.limit(0)).collect() == []


# --- LM scores ---


def test_lm_scores(spark, odd, monkeypatch):
    monkeypatch.setattr(scoring, "STEPS", 5)
    monkeypatch.setattr(scoring, "COMMON", 10)
    rows = spark.createDataFrame([(i, t, 5) for i, t, _ in odd], "doc_id long, text string, word int")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5 != 1
    got = scoring.score(rows, fold).collect()
    counts = Counter()
    for i, t, _ in odd:
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update([*spaced_words((t or "").encode()), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for i, t, _ in odd:
        words = [*spaced_words((t or "").encode()), None]
        base = sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        want.append((i, len(words), sum(counts[w] > 0 for w in words), n, pytest.approx(base)))
    assert sorted(tuple(r)[:5] for r in got) == sorted(want, key=lambda w: w[0])
    assert all(r["score"] < 0 for r in got)
    assert scoring.score(rows.limit(0), fold).collect() == []


@pytest.mark.parametrize("size", [1, 2, 31, 32, 33, 56, 57, 300])
def test_windows_score_each_token_once(size):
    text, start, first = scoring.windows(np.array([size, 3]))
    seen = Counter(a + p for t, a, b in zip(text, start, first) if t == 0 for p in range(b, scoring.CONTEXT) if a + p < size)
    assert seen == Counter(range(size))


def test_frequent_ids_are_those_of_all_texts(spark, monkeypatch):
    monkeypatch.setattr(scoring, "SAMPLE", 1)
    monkeypatch.setattr(scoring, "STEPS", 1)
    rows = [(i, word * 40) for i in range(6) for word in (" apple", " house", " river")]
    docs = spark.createDataFrame([(3 * i + k, t) for k, (i, t) in enumerate(rows)], "doc_id long, text string")
    model = scoring.fit(scoring.encode(docs, F.lit(True)))
    encoder = packing.Encoder(packing.default_vocabulary())
    ids = {int(x) for _, t in rows for x in np.frombuffer(encoder.encode([t])[0], "<u4")} | {50256}
    ranks, inputs = ([int(v[i]) for i in sorted(ids)] for v in (model.vocabulary.ranks, model.vocabulary.inputs))
    assert sorted(ranks) == sorted(inputs) == list(range(len(ids)))


def test_scored_places_see_half_a_window():
    text, start, first = scoring.windows(np.array([500, 33, 7]))
    assert all(seen >= scoring.CONTEXT // 2 for at, seen in zip(start, first) if at)


def test_training_reaches_every_id_of_short_texts(monkeypatch):
    texts = [prose(n, n) for n in (1, 2, 30, 70, 300)] + [prose(3, k) for k in range(40)]
    goals, step = [], scoring.Steps.step

    def counted(self, ids, wanted, used):
        goals.append(int(used.sum()))
        return step(self, ids, wanted, used)

    monkeypatch.setattr(scoring.Steps, "step", counted)
    path = packing.default_vocabulary()
    encoder = packing.Encoder(path)
    size = encoder.tokenizer.get_vocab_size()
    vocabulary = scoring.Vocabulary.of(np.zeros(size), 50256)
    encoded = encoder.encode(texts)
    batches = [pa.RecordBatch.from_arrays([pa.array(encoded[i : i + 7], pa.binary())], ["ids"]) for i in range(0, len(texts), 7)]
    out = list(scoring._trained(vocabulary, scoring.start_weights(vocabulary))(iter(batches)))
    windows = len(scoring.windows(np.array([len(e) // 4 + 1 for e in encoded]), scoring.CONTEXT)[0])
    weight = [r["value"] for b in out for r in b.to_pylist() if r["place"] == -1]
    assert weight == [windows] and sum(goals) == sum(len(e) // 4 + 1 for e in encoded)


@pytest.fixture
def small_model(monkeypatch):
    """A model of 1,100 ids with random weights, of which many share classes."""
    monkeypatch.setattr(scoring, "HEAD", 20)
    monkeypatch.setattr(scoring, "BUCKET", 200)
    monkeypatch.setattr(scoring, "OWN", 300)
    monkeypatch.setattr(scoring, "SHARED", 50)
    rng = np.random.default_rng(0)
    vocabulary = scoring.Vocabulary.of(rng.integers(0, 50, 1100), 7)
    weights = scoring.start_weights(vocabulary)
    weights["tail"] += rng.normal(size=weights["tail"].shape).astype(np.float32) * 0.2
    return scoring.Model(vocabulary, weights)


def test_gradient_and_fast_states(small_model):
    weights = {k: v.astype(np.float64) for k, v in small_model.weights.items()}
    rng = np.random.default_rng(0)
    ids, goals = rng.integers(0, 350, (3, scoring.CONTEXT)), rng.integers(0, 1100, (3, scoring.CONTEXT))
    used = rng.random((3, scoring.CONTEXT)) < 0.7
    slopes = scoring.gradient(weights, ids, goals, used)[1]
    for name, w in weights.items():
        slope = slopes[name]
        if isinstance(slope, tuple):
            rows, values = slope
            slope = np.zeros_like(w)
            slope[rows] = values
        at = (ids[0, 0], 0) if name == "embed" else tuple(rng.integers(0, s) for s in w.shape)
        w[at] += 1e-5
        up = scoring.gradient(weights, ids, goals, used)[0]
        w[at] -= 2e-5
        down = scoring.gradient(weights, ids, goals, used)[0]
        w[at] += 1e-5
        assert slope[at] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-8)
    assert np.allclose(small_model._states(ids).reshape(-1, scoring.WIDTH), scoring._attention(small_model.weights, ids)[0], atol=1e-4)


def test_scoring_makes_states_of_scored_places_only(small_model, monkeypatch):
    made, states = [], scoring.Model._states

    def counted(self, *given):
        out = states(self, *given)
        made.append(out.shape[0] * out.shape[1])
        return out

    monkeypatch.setattr(scoring.Model, "_states", counted)
    small_model.score([np.arange(scoring.CONTEXT + 20 * scoring.STRIDE - 1, dtype="<u4").tobytes()])
    assert sum(made) == scoring.CONTEXT + 20 * scoring.STRIDE


def test_states_from_a_place_on(small_model):
    ids = np.random.default_rng(1).integers(0, 350, (5, scoring.CONTEXT))
    whole = small_model._states(ids).copy()
    for begin in (1, 16, 31):
        assert np.allclose(small_model._states(ids, begin), whole[:, begin:], atol=1e-4)


def test_attention_with_exponents_above_single_precision(small_model):
    ids = np.random.default_rng(2).integers(0, 350, (4, scoring.CONTEXT))
    small_model.weights["qkv"] *= 30
    got, kept = scoring._attention(small_model.weights, ids)
    exact, doubles = scoring._attention({k: v.astype(np.float64) for k, v in small_model.weights.items()}, ids)
    scores = doubles[2] @ doubles[3].transpose(0, 1, 3, 2)
    assert scores.max() > 100  # exp of it is infinite in single precision
    assert np.allclose(got, exact, atol=1e-2 * abs(exact).max()) and np.allclose(kept[5].sum(-1), 1, atol=1e-4)


def test_steps_write_over_their_own_arrays_only(small_model):
    rng = np.random.default_rng(3)
    steps = [(rng.integers(0, 350, (n, scoring.CONTEXT)), rng.integers(0, 1100, (n, scoring.CONTEXT)), rng.random((n, scoring.CONTEXT)) < 0.8) for n in (6, 3, 6)]
    spare = scoring.Spare()
    for step in steps:
        loss, again = scoring.gradient(small_model.weights, *step, spare)
        fresh_loss, fresh = scoring.gradient(small_model.weights, *step)
        assert loss == fresh_loss and again.keys() == fresh.keys()
        for name in again:
            pairs = zip(again[name], fresh[name]) if isinstance(again[name], tuple) else [(again[name], fresh[name])]
            assert all(np.array_equal(a, b) for a, b in pairs)


def plain_shares(model, ids):
    """Probability of every id of the vocabulary after ``ids``, place by place and head by head."""
    w = {k: v.astype(np.float64) for k, v in model.weights.items()}
    own = [w["embed"][model.vocabulary.inputs[i]] for i in ids]
    x = [own[t] + w["place"][t] + (own[t - 1] @ w["before"] if t else 0) for t in range(len(ids))]
    width, mixed = scoring.WIDTH // scoring.HEADS, []
    for head in range(scoring.HEADS):
        q, k, v = (np.array([row @ w["qkv"][:, s : s + width] for row in x]) for s in (scoring.WIDTH * part + width * head for part in range(3)))
        weight = np.exp([q[-1] @ key / math.sqrt(width) for key in k])
        mixed.append(sum(a * row for a, row in zip(weight / weight.sum(), v)))
    y = x[-1] + np.concatenate(mixed) @ w["join"]
    h = y + np.maximum(y @ w["up"] + w["up_bias"], 0) @ w["down"]
    softmax = lambda z: np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    kinds = softmax(h @ w["out"] + w["out_bias"])
    tails = [kinds[scoring.HEAD + b] * softmax(w["tail"][b] @ h + w["tail_bias"][b]) for b in range(len(w["tail"]))]
    return np.concatenate([kinds[: scoring.HEAD], *tails])[model.vocabulary.ranks]


def test_scores_equal_a_plain_version(small_model):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 1100, n) for n in (0, 1, 31, 32, 50, 90)]
    got = small_model.score([t.astype("<u4").tobytes() for t in texts])
    for text, value in zip(texts, got):
        line, want = [7, *text, 7], 0.0
        for t in range(1, len(line)):
            begin = 0 if t <= scoring.CONTEXT else -(-(t - scoring.CONTEXT) // scoring.STRIDE) * scoring.STRIDE
            shares = plain_shares(small_model, line[begin:t])
            assert shares.sum() == pytest.approx(1)
            want += math.log10(shares[line[t]])
        assert value == pytest.approx(want, rel=1e-5)


def test_untrained_ids_have_their_shares():
    counts = np.arange(3000.0)
    vocabulary = scoring.Vocabulary.of(counts, 7)
    weights = scoring.start_weights(vocabulary)
    kinds = np.exp(weights["out_bias"] - weights["out_bias"].max())
    tails = np.exp(weights["tail_bias"])
    shares = np.concatenate([kinds[: scoring.HEAD], (kinds[scoring.HEAD :, None] * tails / tails.sum(1, keepdims=True)).ravel()])
    assert np.allclose(shares[vocabulary.ranks] / kinds.sum(), (counts + 0.5) / (counts + 0.5).sum(), rtol=1e-4)


def test_model_beats_word_counts(spark, monkeypatch):
    """Texts of a few sentences that come again in other orders: context tells the next word, counts do not."""
    monkeypatch.setattr(scoring, "STEPS", 150)
    rng = np.random.default_rng(3)
    lines = [prose(8, k) + "." for k in range(12)]
    docs = spark.createDataFrame([(i, " ".join(rng.choice(lines, 12))) for i in range(300)], "doc_id long, text string")
    got = scoring.score(docs, F.col("doc_id") % 5 != 1).filter("doc_id % 5 = 1").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > 0.7 * got[1]
