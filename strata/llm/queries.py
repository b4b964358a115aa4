"""Queries of the training-data operators: name -> (spark, data folder) ->
DataFrame, and their DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import (collocations, conversations, decontaminate, extraction, fingerprints, language, mixing, near_dup,
                        onebit, privacy, secrets, suffix_tree, toxicity)
from strata.sources.tables import table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}

AZ = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_decontaminate(spark, data_dir):
    """Benchmark windows found in every document, by winnowing."""
    hits = decontaminate.benchmark_hits(table(spark, data_dir, "documents"), table(spark, data_dir, "benchmark"))
    return hits.select("doc_id", "n_words", "n_hit", "n_items",
                       F.sha2(F.concat_ws(",", "item_ids"), 256).alias("items_sha256"),
                       decontaminate.contaminated().alias("contaminated"))


# every 13-word window of the items (or the whole of a shorter item), found by direct comparison
ORACLE["op1_decontaminate"] = rf"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all({AZ.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
items AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS k,
         unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2),
                               lambda i: list_aggregate(w[i:i + least(13, len(w)) - 1], 'string_agg', ' '))) AS win
  FROM bw WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM items),
wins AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS p0,
         unnest(list_transform(range(1, len(w) - k + 2),
                               lambda i: list_aggregate(w[i:i + k - 1], 'string_agg', ' '))) AS win
  FROM dw, ks WHERE len(w) >= k),
hit AS (SELECT DISTINCT doc_id, p0, k FROM wins SEMI JOIN items USING (k, win)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(p0, p0 + k)) AS p FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM wins JOIN items USING (k, win))
          GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op2_fingerprints(spark, data_dir):
    """Bottom-k sketches of every document and of its edited text."""
    return fingerprints.edited_fingerprints(table(spark, data_dir, "documents"))


@query
def op7_near_duplicates(spark, data_dir):
    """Near-duplicate groups of all documents by min-max hashing."""
    return near_dup.near_duplicates(table(spark, data_dir, "documents"), k=3, percent=85)


# all pairs that share a shingle, and the components of the links among them
ORACLE["op7_near_duplicates"] = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({AZ.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 2, 1) + 1),
         lambda i: list_aggregate(w[i:i + 2], 'string_agg', ' '))) AS g
  FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY 1, 2),
link AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (
  SELECT doc_id, doc_id AS other FROM n
  UNION SELECT r.doc_id, e.b FROM reach r JOIN edge e ON r.other = e.a),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(comp.component_id, w.doc_id) AS component_id,
       coalesce(comp.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN comp USING (doc_id)
"""


@query
def op3_secrets(spark, data_dir):
    """Secrets in every document: base patterns and Markov log-likelihood ratios."""
    return secrets.scan(table(spark, data_dir, "documents"))


@query
def op4_private_data(spark, data_dir):
    """Personal data in every document: base patterns and the weakly supervised classifier."""
    return privacy.scan(table(spark, data_dir, "documents"))


@query
def op5_language(spark, data_dir):
    """Language of every document by hyperdimensional profiles."""
    return language.train_and_identify(table(spark, data_dir, "documents")).select(
        "doc_id", "held_out", "lang_pred", "score")


@query
def op6_toxicity(spark, data_dir):
    """Toxicity of every document by scaled character n-grams."""
    return toxicity.train_and_score(table(spark, data_dir, "documents"), table(spark, data_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted")


@query
def op8_mixture(spark, data_dir):
    """Documents of the mixture, once for each pass that takes them."""
    return mixing.mix(table(spark, data_dir, "documents")).select(
        "doc_id", F.col("mix_epoch").alias("epoch"), "domain", "lang", "source", F.col("mix_tokens").alias("n_tokens"))


def _share_sql(level: str, parent: str, path: list[str], weight: str) -> str:
    """One level of the budget tree: cap, weight and budget of each node."""
    up = path[:-1] or ["root"]
    part = ", ".join(up)
    return f"""
{level}_c AS (
  SELECT c.*, p.budget AS b, cap / nullif(CAST(w AS DOUBLE), 0) AS ratio
  FROM (SELECT 1 AS root, {", ".join(path)}, sum(cap) AS cap, {weight} AS w FROM leaf GROUP BY ALL) c
  JOIN {parent} p USING ({part})),
{level}_s AS (
  SELECT *, w > 0 AND cap * (sum(w) OVER (PARTITION BY {part}) - coalesce(sum(w) OVER before, 0))
            <= (b - coalesce(sum(cap) OVER before, 0)) * w AS short
  FROM {level}_c
  WINDOW before AS (PARTITION BY {part} ORDER BY ratio ASC NULLS LAST, {path[-1]}
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
{level} AS (
  SELECT 1 AS root, {", ".join(path)}, CASE WHEN short THEN cap
           ELSE coalesce((b - coalesce(sum(cap) FILTER (short) OVER (PARTITION BY {part}), 0)) * w
                // nullif(sum(w) FILTER (NOT short) OVER (PARTITION BY {part}), 0), 0) END AS budget
  FROM {level}_s)"""


def mixture_sql(documents: str = "documents") -> str:
    """DuckDB SQL of the mixture: each leaf's whole order, without hash ranges."""
    def weight(column, weights):
        return "CASE " + column + "".join(f" WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"
    d, la = weight("dom", mixing.WEIGHTS[0]), weight("la", mixing.WEIGHTS[1])
    return rf"""
WITH docs AS (
  SELECT *, coalesce(lang, '') AS la, coalesce(source, '') AS so, CAST(doc_id AS VARCHAR) AS id,
         len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS tok,
         coalesce(TRY_CAST(nullif(regexp_extract(coalesce(source, ''), '([0-9]{{1,9}})$', 1), '') AS INTEGER), -1) AS num,
         CASE WHEN num BETWEEN 0 AND 4 THEN 'web' WHEN num BETWEEN 5 AND 9 THEN 'books'
              WHEN num BETWEEN 10 AND 14 THEN 'forum' WHEN num BETWEEN 15 AND 19 THEN 'reference'
              ELSE 'other' END AS dom
  FROM {documents}),
leaf AS (SELECT dom, la, so, CAST(sum(tok) AS HUGEINT) AS supply, {mixing.EPOCHS} * supply AS cap FROM docs GROUP BY ALL),
top AS (SELECT 1 AS root, least(sum(cap), sum(supply) * {mixing.PERCENT} // 100) AS budget FROM leaf),
{_share_sql("l1", "top", ["dom"], d)},
{_share_sql("l2", "l1", ["dom", "la"], la)},
{_share_sql("l3", "l2", ["dom", "la", "so"], "1")},
share AS (SELECT dom, la, so, budget, CASE WHEN supply > 0 THEN budget // supply ELSE 0 END AS full_passes,
                 budget - full_passes * supply AS part FROM l3 JOIN leaf USING (dom, la, so)),
pass AS (SELECT unnest(range(0, {mixing.EPOCHS})) AS epoch),
placed AS (
  SELECT d.*, epoch, full_passes, part, md5('{mixing.SEED}:' || epoch || ':' || id) AS h
  FROM docs d JOIN share USING (dom, la, so) JOIN pass ON epoch <= full_passes),
summed AS (
  SELECT *, sum(tok) OVER (PARTITION BY dom, la, so, epoch ORDER BY h, id) - tok AS before FROM placed)
SELECT doc_id, CAST(epoch AS INTEGER) AS epoch, dom AS domain, lang, source, CAST(tok AS BIGINT) AS n_tokens
FROM summed WHERE epoch < full_passes OR before < part
"""


ORACLE["op8_mixture"] = mixture_sql()


@query
def op9_language_model(spark, data_dir):
    """Language-model scores of every document by a probabilistic suffix tree."""
    return suffix_tree.train_and_score(table(spark, data_dir, "documents")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op10_extraction(spark, data_dir):
    """Main text of every page by site style trees."""
    return extraction.extract(table(spark, data_dir, "pages"))


@query
def op11_conversations(spark, data_dir):
    """Cheapest repair of every conversation after planted damage, by a run-length dynamic program."""
    return conversations.audit(conversations.damaged(table(spark, data_dir, "conversations")))


def _least_sql(state: int, choices: list[tuple[str, str, str, int]]) -> str:
    """Least (cost, audit) over (condition, added cost, letter, next state)."""
    return "list_min([" + ", ".join(
        f"CASE WHEN {cond} THEN {{'c': v[{nxt + 1}].c + {cost}, 'a': '{letter}' || v[{nxt + 1}].a}} END"
        for cond, cost, letter, nxt in choices) + "])"


def _step_sql() -> str:
    """A row applied to ``v``, the least (cost, audit) left from each state;
    a row may have up to three insertions before it."""
    def own(q):
        after = (2, 2, 3, 2)[q]
        keep = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[q]
        return ([("true", "4", "D", q), ("sym NOT IN ('b', 'd')", "3 + extra", "R", after)]
                + [(f"lower(sym) = '{s}'", "extra", "K", to) for s, to in keep])
    out = []
    for q in range(4):
        choices, state, prefix, spent = list(own(q)), q, "", 0
        for _ in range(3):
            state, prefix, spent = (2, 2, 3, 2)[state], prefix + "I", spent + 3
            choices += [(cond, f"{spent} + {cost}", prefix + letter, nxt) for cond, cost, letter, nxt in own(state)]
        out.append(_least_sql(q, choices))
    return "[" + ", ".join(out) + "]"


# crc32 from its table; the recurrence from each conversation's last row to its first; the audit read back into rows
ORACLE["op11_conversations"] = rf"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 1, 1, 1, 1, 1, 1, 1, 1],
                          lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
    FROM range(256) r(i))),
named AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name
  FROM conversations),
fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           range(1, strlen(name) + 1), lambda i: CAST(ascii(substr(name, CAST(i AS INTEGER), 1)) AS BIGINT))),
           lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8))) % 20 AS fate
  FROM named, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 0 THEN 0 WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM fated),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text), copy) AS p,
         regexp_replace(text, '[ 	-]+$', '') AS bare
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN bare = '' THEN 'b'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 'd'
                 WHEN right(bare, 1) IN ('.', '!', '?') THEN ini ELSE upper(ini) END AS sym,
         CASE WHEN sym IN ('S', 'U', 'A', 'O') THEN 3 ELSE 0 END AS extra,
         lag(role) OVER (PARTITION BY conv_id ORDER BY p) AS prev, p > 1 AS later
  FROM (SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'o' END AS ini FROM placed)),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (sym = 'b') AS blank, count(*) FILTER (sym = 'd') AS duplicate,
         count(*) FILTER (extra > 0) AS truncated,
         count(*) FILTER (later AND left(prev, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id),
walk AS (
  SELECT conv_id, n AS p, [{{'c': 0, 'a': ''}}, {{'c': 6, 'a': 'II'}}, {{'c': 3, 'a': 'I'}}, {{'c': 0, 'a': ''}}] AS v FROM facts
  UNION ALL
  SELECT w.conv_id, w.p - 1, {_step_sql()}
  FROM walk w JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.p = w.p),
audits AS (SELECT conv_id, v[1].c AS cost, v[1].a AS audit FROM walk WHERE p = 0),
letters AS (
  SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS i FROM audits),
spelled AS (
  SELECT conv_id, i, substr(audit, CAST(i AS INTEGER), 1) AS letter,
         i - length(replace(substr(audit, 1, CAST(i AS INTEGER)), 'I', '')) AS inserted,
         length(replace(substr(audit, 1, CAST(i AS INTEGER)), 'D', '')) AS said
  FROM letters),
lines AS (
  SELECT s.*, f.role, f.text, first_value(letter = 'K' AND left(role, 1) = 's') OVER (
           PARTITION BY s.conv_id ORDER BY s.i) AS system_first
  FROM spelled s LEFT JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM s.conv_id AND letter <> 'I' AND f.p = s.i - s.inserted
  WHERE letter <> 'D'),
repaired AS (
  SELECT conv_id, string_agg(
           CASE WHEN letter = 'K' THEN role WHEN (said - CAST(system_first AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY i) AS whole
  FROM lines GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(cost, 0) AS BIGINT) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM o.conv_id
"""


@query
def op12_nearest(spark, data_dir):
    """The 5 nearest vectors of every 50th vector, by rotated one-bit codes."""
    codes = onebit.index(table(spark, data_dir, "embeddings"))
    return onebit.search(codes, onebit.every_nth(codes, 50), 5)


# brute force
ORACLE["op12_nearest"] = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM near)
SELECT query_id, CAST(r AS INTEGER) AS rank, vec_id, score FROM ranked WHERE r <= 5
"""


@query
def op13_collocations(spark, data_dir):
    """Each language's first phrase collocations, by stripes."""
    return collocations.ranked(collocations.collocations(table(spark, data_dir, "documents")))


ORACLE["op13_collocations"] = rf"""
WITH pieces AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         unnest(string_split_regex({AZ.format("coalesce(text, '')")}, '[.,;:!?
-]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces),
n AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
grams AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2),
                         lambda i: list_aggregate(w[i:i + m - 1], 'string_agg', ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {collocations.LEAST}),
cand AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cuts AS (SELECT *, unnest(range(1, m)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.phrase, c.m, a, k, x.f AS l, y.f AS r, CAST({collocations.SCALE} * CAST(a AS HUGEINT) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = list_aggregate(w[1:k], 'string_agg', ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = list_aggregate(w[k + 1:], 'string_agg', ' ')),
lowest AS (SELECT lang, phrase, m, a, arg_min({{'l': l, 'r': r, 'score': score}}, score * 10 + k) AS b FROM scored GROUP BY ALL),
kept AS (
  SELECT * FROM lowest p WHERE NOT EXISTS (
    SELECT 1 FROM cand q WHERE q.lang = p.lang AND q.m > p.m AND 100 * q.a >= {collocations.SHARE} * p.a
      AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY b.score DESC, a DESC, phrase) AS rank, phrase, a,
         b.l AS l, b.r AS r, CAST(n AS BIGINT) AS n, b.score AS score
  FROM kept JOIN n USING (lang)) WHERE rank <= {collocations.TOP}
"""
