"""The registered query of every operator: production parameters, whole tables; SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import (
    contamination,
    infill,
    language,
    licences,
    manifest,
    mixing,
    packing,
    scoring,
    simhash,
    suffixes,
    toxicity,
    urls,
    vectors,
)
from marketlake.llm.common import fold, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; labels are learnt from the rows outside the held-out fold."""
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels, toxicity.training_rows())
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document, and the smallest document reachable over 3 or fewer bits."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, bits=3)


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every document without the 100-byte strings that also start earlier."""
    return suffixes.repeat_digests(read(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds at least 0.8 of a benchmark item's five-word shingles, with the item."""
    return contamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def sql_words(text: str) -> str:
    """DuckDB: lower-cased words of ASCII letters and digits and all non-ASCII characters."""
    lower = f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _sql_shingles(table: str, key: str) -> str:
    return f"""SELECT DISTINCT {key}, unnest(CASE WHEN len(w) >= 5
      THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS shingle
    FROM (SELECT {key}, {sql_words('text')} AS w FROM {table})"""


SQL["op3_decontamination"] = f"""
WITH item AS ({_sql_shingles("benchmark", "item_id")}), doc AS ({_sql_shingles("documents", "doc_id")}),
sizes AS (SELECT item_id, count(*) AS n_item FROM item GROUP BY item_id),
found AS (SELECT doc_id, item_id, count(*) AS n_found FROM doc JOIN item USING (shingle) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment
FROM found JOIN sizes USING (item_id) WHERE n_found / n_item >= 0.8"""


@query
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token piece of the documents with its place in a sequence of at most 1024 tokens."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; learnt from the rows outside the held-out fold."""
    docs = read(spark, sf_dir, "documents")
    predicted = language.predict(docs, language.train(docs, language.training_rows()))
    return predicted.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score", "accepted")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted license templates of every document."""
    return licences.scan(read(spark, sf_dir, "documents")).drop("spans")


def _sql_places(phrase: str) -> str:
    words = phrase.split()
    return " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(words, 1))


_ALL_BASE = " OR ".join(f"({_sql_places(p)})" for p in licences.BASE)
_BASE_LABELS = ", ".join(
    f"CASE WHEN len(list_filter(range(len(w)), lambda i: {_sql_places(p)})) > 0 THEN '{label}' END" for p, label in licences.BASE.items()
)
_OWN_LABELS = ", ".join(
    f"CASE WHEN regexp_matches(line, ' {licences.pattern(t)}') THEN '{label}' END" for label, t in licences.TEMPLATES.items()
)
SQL["op5_licenses"] = f"""
WITH d AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
e AS (SELECT doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS line,
        list_filter(range(len(w)), lambda i: {_ALL_BASE}) AS places FROM d),
f AS (SELECT doc_id, len(w) AS n_words, places,
        list_filter([{_BASE_LABELS}], lambda x: x IS NOT NULL) AS base,
        list_filter([{_OWN_LABELS}], lambda x: x IS NOT NULL) AS own FROM e)
SELECT doc_id, n_words, len(places) AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
  coalesce(array_to_string(list_sort(base), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(base, own))), ','), '') AS labels,
  CASE WHEN len(own) > 0 THEN 1.0 WHEN len(places) > 0 THEN 0.5 ELSE 0.0 END::DOUBLE AS score
FROM f"""

#: Rules of the URL query: verdict, host, path.
RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "example.com", "/en/"),
    urls.Rule("allow", "www.example.com", "/en/"),
    urls.Rule("block", "net", "/es/"),
    urls.Rule("block", "net", "/fr/"),
]
#: Sites whose crawled URLs make up the list of the URL query.
LISTED_SITES = ["ads-track", "casino-win", "spam-farm", "adult-x", "cheap-pills", "free-bets"]
_SITES = "(^|[.])(" + "|".join(LISTED_SITES) + ")[.]"


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL: the longest rule that fits, else the list of the unwanted sites' URLs."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    listed = pages.filter(urls.host("url").rlike(_SITES)).select("url")
    judged = urls.judge(pages, RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical_url", "listed")


_SQL_FITS = " ".join(
    f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}') THEN {{{r.text!r}}}"
    for r in sorted(RULES, key=lambda r: -len(r.text))
)


def _sql_case(value: dict[str, str]) -> str:
    out = _SQL_FITS
    for key, text in value.items():
        out = out.replace("{" + repr(key) + "}", f"'{text}'")
    return f"CASE {out} END"


_SQL_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)[?]?([^#]*)"
SQL["op9_url_filter"] = f"""
WITH parts AS (SELECT page_id,
    translate(coalesce(regexp_extract(url, '{_SQL_PARTS}', 1), ''), '{urls._UPPER}', '{urls._LOWER}') AS host,
    coalesce(regexp_extract(url, '{_SQL_PARTS}', 2), '') AS path,
    list_sort(list_filter(string_split(coalesce(regexp_extract(url, '{_SQL_PARTS}', 3), ''), '&'),
      lambda f: f <> '' AND NOT starts_with(f, 'utm_') AND NOT starts_with(f, 'ref='))) AS fields FROM pages),
named AS (SELECT page_id, host, path, regexp_replace(host, '^www[.]', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(fields) > 0 THEN '?' || array_to_string(fields, '&') ELSE '' END AS canonical_url FROM parts),
listed AS (SELECT DISTINCT canonical_url FROM named WHERE regexp_matches(host, '{_SITES}') AND canonical_url <> ''),
judged AS (SELECT *, {_sql_case({r.text: r.text for r in RULES})} AS rule, {_sql_case({r.text: r.verdict for r in RULES})} AS decided,
    canonical_url IN (SELECT canonical_url FROM listed) AS listed FROM named)
SELECT page_id, host, path, rule, coalesce(decided, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict, canonical_url, listed
FROM judged"""


@query
def op1_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector among those of its label, at cosine 0.98."""
    return vectors.near_duplicates(read(spark, sf_dir, "embeddings"), least=0.98)


@query
def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """log10 probability of every document under the attention model, and under smoothed word counts."""
    docs = read(spark, sf_dir, "documents")
    scored = scoring.score(docs, fold("doc_id", 5) != 1)
    held_out = (fold("doc_id", 5) == 1).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture takes of every document: sources weigh 3, 1, 2 in turn and share 150 % of all words."""
    mixed = mixing.repetitions(read(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL["op11_mixing"] = r"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(sha256(concat_ws(':', '42', coalesce(doc_id::VARCHAR, '-'), coalesce(source, '-'), coalesce(text, '-'))), 1, 13))::BIGINT
      / 4503599627370496::DOUBLE AS draw FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM docs GROUP BY source),
-- sources in the order in which they reach twice their size, and the level when k of them are held there
held AS (SELECT *, row_number() OVER reach AS k, sum(source_size) OVER () * 3 - sum(source_size) OVER reach * 4 + source_size * 4 AS rest,
    sum(weight) OVER () - sum(weight) OVER reach + weight AS weights FROM sums
    WINDOW reach AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
level AS (SELECT * FROM held WHERE weight * rest <= 4 * source_size * weights ORDER BY k LIMIT 1),
targets AS (SELECT h.source, h.source_size, CASE WHEN l.k IS NULL OR h.k < l.k THEN (2 * h.source_size)::DOUBLE
    ELSE (h.weight * l.rest)::DOUBLE / (2 * l.weights)::DOUBLE END AS target FROM held h LEFT JOIN level l ON true),
rates AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets)
SELECT doc_id, size, source_size, target,
  size * (floor(rate)::BIGINT + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS taken
FROM docs JOIN rates ON docs.source IS NOT DISTINCT FROM rates.source"""


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether its text as it is after tampering still verifies."""
    docs = read(spark, sf_dir, "documents")
    first = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaves = docs.select(
        "doc_id", "source", manifest.leaf_of(*first, F.col("text")).alias("leaf"),
        F.when(tampered, manifest.leaf_of(*first, lowered)).alias("now"),
    )
    built = manifest.build(leaves, leaf="leaf", group="source", key="doc_id", carry=["now"])
    return manifest.verified_rows(built).drop("_c0").withColumnRenamed("key", "doc_id")


#: Levels of the SQL twin, enough for 16^6 leaves a tree.
_SQL_LEVELS = 6


def _sql_tree(name: str, source: str) -> str:
    """DuckDB: per level, digest of every node with those of its siblings to the left and right; the last level is the root."""
    out = [f"{name}0 AS (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM ({source}))"]
    for k in range(_SQL_LEVELS):
        run = "PARTITION BY tree, i // 16 ORDER BY i ROWS BETWEEN"
        out.append(f"""{name}s{k} AS (SELECT tree, i, n, CASE WHEN n > 1 THEN coalesce(string_agg(digest, '')
              OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') END AS l,
            CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') END AS r FROM {name}{k})""")
        out.append(f"""{name}{k + 1} AS (SELECT tree, i // 16 AS i, (any_value(n) + 15) // 16 AS n,
            CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY i)) ELSE any_value(digest) END AS digest
            FROM {name}{k} GROUP BY tree, i // 16)""")
    return ",\n".join(out)


def _sql_enc(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR)) || ':' || {value}::VARCHAR, '-')"


_SQL_LEAF = "sha256(" + " || ".join(_sql_enc(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || {})"
_SQL_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: A polynomial remainder has no function in DuckDB: crc32 bit by bit over the digits of an id.
_SQL_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda p: ord(substr(doc_id::VARCHAR, p, 1))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda v, step: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))"""


def _sql_climb(start: str, aliases: list[str]) -> str:
    for a in aliases:
        start = f"CASE WHEN {a}.l IS NULL THEN {start} ELSE sha256({a}.l || {start} || {a}.r) END"
    return start


_SQL_STEPS = [f"a{k}" for k in range(_SQL_LEVELS)] + [f"b{k}" for k in range(_SQL_LEVELS)]
_SQL_JOINS = " ".join(f"JOIN lowers{k} a{k} ON a{k}.tree = d.tree AND a{k}.i = d.i // {16**k}" for k in range(_SQL_LEVELS)) + " " + " ".join(
    f"JOIN uppers{k} b{k} ON b{k}.i = t.i // {16**k}" for k in range(_SQL_LEVELS)
)
SQL["op12_manifest"] = f"""
WITH d AS (SELECT doc_id, coalesce('1' || source, '0') AS tree, {_SQL_LEAF.format(_sql_enc('text'))} AS leaf,
    CASE WHEN xor({_SQL_CRC}, 4294967295) % 5 = 0 THEN {_SQL_LEAF.format(_sql_enc(_SQL_LOWER))} END AS now FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d),
{_sql_tree('lower', 'SELECT tree, i, leaf AS digest FROM leaves')},
roots AS (SELECT tree, digest AS subroot, row_number() OVER (ORDER BY encode(tree)) - 1 AS i FROM lower{_SQL_LEVELS}),
{_sql_tree('upper', "SELECT 0 AS tree, i, subroot AS digest FROM roots")},
steps AS (SELECT d.doc_id, d.leaf, t.subroot, {_sql_climb('coalesce(d.now, d.leaf)', _SQL_STEPS)} AS folded_root,
    sha256({' || '.join(f"coalesce({a}.l || {a}.r, '')" for a in _SQL_STEPS)}) AS proof_sha256
  FROM leaves d JOIN roots t ON t.tree = d.tree {_SQL_JOINS})
SELECT doc_id, leaf, subroot, digest AS root, proof_sha256, folded_root, folded_root = digest AS verified FROM steps, upper{_SQL_LEVELS}"""


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a fill-in-the-middle sample: its form, the lengths of its parts, digests of sample and restored text."""
    made = infill.transform(read(spark, sf_dir, "documents"), seed=42, rate=50, spm=80)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infill.restored("output", "form"), 256).alias("restored_sha256"),
    )


SQL["op13_infill"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u FROM documents),
e AS (SELECT *, len(u) AS n, [('0x' || h[8 * i - 7 : 8 * i])::BIGINT for i in [1, 2, 3, 4]] AS h4 FROM d),
f AS (SELECT *, least(h4[1] % (n + 1), h4[2] % (n + 1)) AS a, greatest(h4[1] % (n + 1), h4[2] % (n + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h4[3] % 100 >= 50 THEN 'plain'
      WHEN h4[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM e),
g AS (SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 : n], '') AS s FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(text) AS restored_sha256 FROM g"""
