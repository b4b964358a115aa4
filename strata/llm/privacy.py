"""Personal data by weak supervision.

Candidate spans come from wide patterns; labelers vote on each: its regular
expression (format and check digits), gazetteers (mail words, card issuers,
calling codes, address ranges) and its context (words before it, characters
around it).  Expectation-maximisation over the vote patterns estimates each
labeler's reliability per kind and a probability per pattern, and those
probabilities train a naive Bayes classifier over span features, which
decides the final spans.  The spans of the base patterns always stay; the
classifier adds others.

DataFrame functions only on all rows.  The driver sees the counts of vote
and feature patterns, whose number is fixed by the labelers and features.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm import spans
from strata.llm.storage import cut

KINDS = ["email", "ip", "card", "phone"]

# fixed values: the base patterns
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}+"
CARD = r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

# wide patterns of further candidates
WIDE = {
    0: r"[A-Za-z0-9._%+-]++\x20?(?:\(at\)|\[at\]|@)\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    1: r"(?<![0-9.])[0-9]{1,3}+(?:\x20?(?:\.|\[\.\])\x20?[0-9]{1,3}+){3}+(?![0-9.])",
    2: r"(?<![0-9])[0-9]{4}(?:[.\x20-][0-9]{4}){2}[.\x20-][0-9]{2,7}(?![0-9])",
    3: r"(?<![0-9+(])(?:00[1-9][0-9]{0,2}[\x20.-])?\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
WIDE_HINT = {0: r"@|\((?:at)\)|\[at\]", 1: r"[0-9]\x20?(?:\.|\[\.\])\x20?[0-9]", 2: r"[0-9]{4}[.\x20-][0-9]{4}",
             3: r"[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}"}

# gazetteers and context words (lists to be extended by the user)
MAIL_ENDS = r"(?i)\.(?:com|net|org|edu|gov|info|io|co|de|fr|es|uk|eu)\z"
ISSUERS = r"\A(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CALLING = r"\A\(?(?:\+|00)?\(?(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
NATIONAL = r"\A1?[2-9][0-9]{2}[2-9][0-9]{6}\z"      # area code and exchange begin with 2 to 9
UNLIKELY_IP = r"\A0|\A(?:[0-9]{1,2}\.){3}[0-9]\z"          # version-like or reserved
CUES = [r"(?i)(?:e-?mail|mail|contact|write|correo|courriel|kontakt)\W*\z",
        r"(?i)(?:\bip|address|host|server|addr)\W*\z",
        r"(?i)(?:card|visa|amex|mastercard|credit|karte|carte|tarjeta)\W*\z",
        r"(?i)(?:phone|tel|telephone|call|fax|mobile|cell|telefon|tel\.)\W*\z"]

LABELERS = ["format", "gazetteer", "context"]
FEATURES = ["length", "digits", "shape", "edge"]
ROUNDS = 25              # of expectation-maximisation
SHRINK = 3.0             # pseudo-counts of a feature's value
ACCEPT = 0.8             # a span this probable is added
BEFORE = 24              # characters of context


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(m: Column) -> Column:
    d = F.reverse(_digits(m))
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda s, i: s + F.when(
        i % 2 == 1, F.substring(d, i, 1).cast("int")).otherwise(
        F.element_at(F.expr("array(0,2,4,6,8,1,3,5,7,9)"), F.substring(d, i, 1).cast("int") + 1)))
    return total % 10 == 0


def _valid(kind: int):
    """The base rule of a kind, on matched text."""
    if kind == 0:
        return None
    if kind == 1:
        return lambda m: m.rlike(rf"\A{PART}(?:\.{PART}){{3}}\z")
    if kind == 2:
        return lambda m: F.when(F.length(_digits(m)).between(14, 19), _luhn(m)).otherwise(F.lit(False))
    return lambda m: F.length(_digits(m)).between(10, 15)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns, by start and kind."""
    return spans.ordered(
        spans.found(text, EMAIL, 0, None, "@"),
        spans.found(text, IP, 1, _valid(1), r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
        spans.found(text, CARD, 2, _valid(2), r"[0-9](?:[\x20-]?[0-9]){13}"),
        spans.found(text, PHONE, 3, _valid(3), r"\+[0-9]"))


def wide_spans(text: Column) -> Column:
    return spans.ordered(*[spans.found(text, p, k, None, WIDE_HINT[k]) for k, p in WIDE.items()])


def _by_kind(kind: Column, values: list[Column]) -> Column:
    out = F.lit(0)
    for i, v in enumerate(values):
        out = F.when(kind == i, v).otherwise(out)
    return out


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _described(text: Column, found: Column) -> Column:
    """Votes and features of each span."""
    def one(x):
        k, m, d = x["k"], x["m"], _digits(x["m"])
        before = F.substring(text, F.greatest(x["s"] - BEFORE + 1, F.lit(1)), F.least(x["s"], F.lit(BEFORE)))
        last = F.when(x["s"] > 0, F.substring(text, x["s"], 1)).otherwise(F.lit(" "))
        after = F.substring(text, x["e"] + 1, 1)
        glued = last.rlike("[A-Za-z0-9_/=-]") | after.rlike("[A-Za-z0-9_/=]")
        fmt = _by_kind(k, [
            _vote(m.rlike(r"\A[^\x20@]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++\z"), m.rlike(r"\A[._%+-]|--")),
            _vote(_valid(1)(m), ~_valid(1)(F.regexp_replace(m, r"[\x20\[\]]", ""))),
            _vote(_valid(2)(m), ~_luhn(m)),
            F.when(m.rlike(r"\A(?:\+|00)"), _vote(F.length(d).between(10, 15), F.length(d) < 10)).otherwise(
                _vote(d.rlike(NATIONAL), ~d.rlike(NATIONAL)))])
        gaz = _by_kind(k, [
            _vote(m.rlike(MAIL_ENDS), m.rlike(r"(?i)\.(?:png|jpg|gif|js|css|py|txt)\z")),
            _vote(~m.rlike(UNLIKELY_IP), m.rlike(UNLIKELY_IP)),
            _vote(d.rlike(ISSUERS), d.rlike(r"\A0")),
            _vote(m.rlike(CALLING), d.rlike(r"\A0{4}|\A1234"))])
        cue = _by_kind(k, [_vote(before.rlike(c), glued) for c in CUES])
        shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[A-Za-z]+", "a"), r"(?:[a9][._%+-]?)++", "x")
        return F.struct(
            x["s"].alias("s"), k.alias("k"), x["e"].alias("e"), m.alias("m"), F.array(fmt, gaz, cue).alias("votes"),
            F.array(F.least(F.floor(F.length(m) / 4), F.lit(10)).cast("string"),
                    F.round(F.length(d) / F.length(m), 1).cast("string"),
                    F.substring(shape, 1, 6), F.concat(
                        F.when(last.rlike(r"\s"), "s").when(last.rlike("[A-Za-z0-9]"), "w").otherwise("p"),
                        F.when(after.rlike(r"\s") | (after == ""), "s").when(after.rlike("[A-Za-z0-9]"), "w").otherwise("p"))
                    ).alias("features"))
    return F.transform(found, one)


def reliabilities(patterns: dict) -> tuple[dict, dict]:
    """Expectation-maximisation over {(kind, votes): count} ->
    (probability per pattern, labeler tables per kind).  The start trusts
    the majority of the votes; counts are smoothed by one."""
    belief = {p: 0.5 + 0.45 * max(-1, min(1, sum(p[1]))) if any(p[1]) else 0.3 for p in patterns}
    tables: dict = {}
    for _ in range(ROUNDS):
        weight = defaultdict(lambda: [1.0, 1.0])
        seen: dict = defaultdict(lambda: 1.0)
        for (kind, votes), n in patterns.items():
            for true, b in ((1, belief[kind, votes]), (0, 1 - belief[kind, votes])):
                weight[kind][true] += n * b
                for i, v in enumerate(votes):
                    seen[kind, true, i, v] += n * b
        tables = {}
        for kind in weight:
            tables[kind] = {"prior": weight[kind][1] / sum(weight[kind]),
                            "votes": {(t, i, v): seen[kind, t, i, v] / (weight[kind][t] + 2)
                                      for t in (0, 1) for i in range(len(LABELERS)) for v in (-1, 0, 1)}}
        for kind, votes in patterns:
            t = tables[kind]
            odds = math.log(t["prior"] / (1 - t["prior"])) + sum(
                math.log(t["votes"][1, i, v] / t["votes"][0, i, v]) for i, v in enumerate(votes))
            belief[kind, votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return belief, tables


def train_classifier(counts: list) -> dict:
    """{(kind, feature, value): log ratio} and {kind: log prior odds} from
    rows (k, votes, features, n), labelled by the votes' probabilities.  A
    value's counts are joined by ``SHRINK`` more in the kind's proportion, so
    a value seen a few times says little."""
    patterns: dict = defaultdict(int)
    for r in counts:
        patterns[r["k"], tuple(r["votes"])] += r["n"]
    belief, _ = reliabilities(patterns)
    mass: dict = defaultdict(lambda: [1.0, 1.0])
    part: dict = defaultdict(lambda: [0.0, 0.0])
    for r in counts:
        b = belief[r["k"], tuple(r["votes"])]
        for true, w in ((1, b), (0, 1 - b)):
            mass[r["k"]][true] += r["n"] * w
            for name, value in zip(FEATURES + LABELERS, [*r["features"], *map(str, r["votes"])]):
                part[r["k"], name, value][true] += r["n"] * w
    return {**{k: math.log(m[1] / m[0]) for k, m in mass.items()},
            **{key: math.log((p[1] / m[1] + SHRINK / sum(m)) / (p[0] / m[0] + SHRINK / sum(m)))
               for key, p in part.items() for m in [mass[key[0]]]}}


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base, added) of every row: base spans, and candidates that the
    classifier accepts and that overlap no base span.

    A null or empty text has no spans; repeated rows each get theirs; other
    columns are not read.  Without candidates nothing is learned or added.
    """
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    read = (source.select("doc_id", "t", base_spans(F.col("t")).alias("base"), wide_spans(F.col("t")).alias("wide"))
            .withColumn("wide", spans.apart(F.col("wide"), F.col("base"))))
    read = cut(read.select("doc_id", "base", _described(F.col("t"), F.col("wide")).alias("wide"),
                           _described(F.col("t"), F.col("base")).alias("told")))
    counts = (read.select(F.explode(F.concat("told", "wide")).alias("x"))
              .groupBy("x.k", "x.votes", "x.features").agg(F.count("*").alias("n")).collect())   # pattern counts
    weights = train_classifier(counts)
    kinds = [k for k in weights if isinstance(k, int)]
    chosen = [(k, list(v), list(f)) for k, v, f in {(r["k"], tuple(r["votes"]), tuple(r["features"])) for r in counts}
              if weights[k] + sum(weights[k, name, value] for name, value in
                                  zip(FEATURES + LABELERS, [*f, *map(str, v)])) >= math.log(ACCEPT / (1 - ACCEPT))] if kinds else []
    yes = F.array(*[F.lit(_key(k, v, f)) for k, v, f in sorted(chosen)]) if chosen else F.expr("cast(array() as array<string>)")
    added = F.filter("wide", lambda x: F.array_contains(yes, F.concat_ws("|", x["k"].cast("string"), F.concat_ws(
        ",", F.transform(x["votes"], lambda v: v.cast("string"))), F.concat_ws(",", x["features"]))))
    plain = F.transform(added, lambda x: F.struct(x["s"], x["k"], x["e"], x["m"]))
    # candidates of different kinds may overlap: the earlier one stays
    return read.select("doc_id", "base", F.aggregate(
        plain.cast(spans.TYPE), spans.none(), lambda out, x: F.when(
            F.exists(out, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"])), out).otherwise(F.concat(out, F.array(x)))
    ).alias("added"))


def _key(k, votes, features) -> str:
    return "|".join([str(k), ",".join(map(str, votes)), ",".join(features)])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``find`` with counts and the spans written as text."""
    base, every = F.col("base"), spans.ordered(F.col("base"), F.col("added"))
    return find(docs, id_col, text_col).select(
        "doc_id", *[spans.count(base, i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(spans.listed(base, KINDS), 256).alias("base_sha256"), spans.listed(every, KINDS).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str | None = "n_chars") -> DataFrame:
    """``docs``, same columns, with each span replaced by its kind in angle
    brackets, and ``size_col`` (if there) set to the new length of changed
    texts.  Texts are matched to their spans by content, so repeated ids are
    no matter; the spans of at most a broadcast's worth of texts are
    broadcast, beyond that both sides are shuffled."""
    text, key = F.col(f"`{text_col}`"), F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256)
    hits = cut(find(docs.select(key.alias("__key"), text.alias("__text")), "__key", "__text")
               .select(F.col("doc_id").alias("__key"), spans.ordered(F.col("base"), F.col("added")).alias("__spans"))
               .where("size(__spans) > 0").dropDuplicates(["__key"]))
    bytes_ = hits.agg(F.coalesce(F.sum(F.size("__spans") * 64 + 100), F.lit(0))).first()[0]
    joined = docs.withColumn("__key", key).join(F.broadcast(hits) if bytes_ <= 32 << 20 else hits, "__key", "left")
    new = spans.replaced(text, F.coalesce("__spans", spans.none()), KINDS)
    out = {text_col: F.when(F.col("__spans").isNull(), text).otherwise(new)}
    joined = joined.withColumn("__text", out[text_col])
    return joined.select(*[
        F.col("__text").alias(c) if c == text_col else
        F.when(F.col("__spans").isNull(), F.col(f"`{c}`")).otherwise(F.length("__text")).cast(docs.schema[c].dataType).alias(c)
        if c == size_col else F.col(f"`{c}`") for c in docs.columns])
