"""Personal data by candidate gradient boosting.

High-recall patterns propose spans per kind, valid or not: addresses without a dot or written with (at),
dotted number groups of any value, digit runs of card length with any checksum, phone numbers with any
number of digits or without the plus. Spans that pass their kind's validity rule are always kept. The
trees are fitted, on a bounded sample of documents, to tell valid from invalid candidates by format and
context alone (the checks themselves and the signs that make a candidate valid are no features). Texts are
split into two folds by their hash: the trees see the one, and a threshold per kind is calibrated on all
candidates of the other. Further candidates are added where the held-out candidates of their own band of
probability, those that look and stand like them, are valid to the wanted precision.

Everything per document happens within its row with built-in functions; only counts by kind and rounded
probability are shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venue_analytics.llm import boosting
from venue_analytics.llm.common import bounded_sample, let, table, text_of

KINDS = ("email", "ip", "card", "phone")

_LOCAL, _LABEL = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
#: Candidates per kind. A run of local characters is tried from its start (or where the last match ended)
#: only, and repetitions are possessive: same matches, no backtracking over long runs.
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@(?:{_LABEL}++(?:\.{_LABEL}++)++|{_LABEL}++(?![A-Za-z0-9._%+@-]))"
             rf"|(?<![A-Za-z0-9._%+@-]){_LOCAL}{{1,64}}+\x20?[(\[]at[)\]]\x20?{_LABEL}{{1,63}}+"
             rf"(?:(?:\.|\x20?[(\[]dot[)\]]\x20?){_LABEL}{{1,63}}+){{1,8}}+(?![A-Za-z0-9._%+@-])",
    "ip": r"(?<![0-9A-Fa-f:.])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Fa-f:.])"
          r"|(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]"
             r"|(?<![0-9A-Za-z+().-])\(?[0-9]{2,4}+\)?[\x20.-]?[0-9]{2,4}+[\x20.-][0-9]{3,4}+(?![0-9A-Za-z+.-])",
}
#: what a text must hold for the pattern to be tried
_NEEDS = {"email": "@|[(\\[]at[)\\]]", "ip": "[0-9]", "card": "[0-9]", "phone": "[0-9]"}
#: zeros alone, or a value up to 255 behind any zeros
_OCTET = "(?:0++(?![0-9])|0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9][0-9]?))"
_POSITIVE = "tel|phone|fax|call|mobil|mail|contact|ip|host|addr|server|card|visa|credit|pay|carte|karte|tarjeta|correo|anruf"
_NEGATIVE = "order|version|build|sku|invoice|serial|no\\.|nr\\.|#|id"
#: code points of context looked at before and after a span
BEFORE, AFTER = 24, 4
FEATURES = ("kind", "digits", "letters", "separators", "left", "right", "cue", "doubt", "first", "distinct")
_BLOCK = 256
#: probabilities are rounded down to this part of one
SCORES = 1000


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def _valid(kind: str, m: Column) -> Column:
    n = F.length(_digits(m))
    return {
        "email": m.rlike(rf"^{_LOCAL}++@{_LABEL}++\."),
        "ip": m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "card": n.between(12, 19) & F.call_function("luhn_check", F.when(n.between(12, 19), _digits(m)).otherwise("1")),
        "phone": m.startswith("+") & n.between(9, 15),
    }[kind]


def _running(steps: Column) -> Column:
    """Running sums of a bound, not empty array of integers, by blocks, so that long arrays aren't copied once per entry."""
    def sums(a: Column, first: Column) -> Column:
        return F.aggregate(a, F.struct(first.alias("at"), F.array().cast("array<int>").alias("all")),
                           lambda s, x: F.struct((s["at"] + x).alias("at"), F.array_append(s["all"], s["at"] + x).alias("all")))["all"]
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    blocks = F.transform(F.sequence(F.lit(1), F.size(steps), F.lit(_BLOCK)), lambda i: F.slice(steps, i, _BLOCK))
    return let(blocks, lambda b: let(
        sums(F.transform(b, total), F.lit(0)),
        lambda ends: F.flatten(F.transform(b, lambda a, k: sums(a, F.coalesce(F.get(ends, k - 1), F.lit(0)))))))


def _side(c: Column) -> Column:
    """0: text end or white space, 1: ASCII letter or digit, 2: other."""
    return F.when((c == "") | c.rlike(r"^\s"), 0).when(c.rlike("^[A-Za-z0-9]"), 1).otherwise(2)


def _candidate(kind: str, m: Column, before: Column, after: Column, start: Column) -> Column:
    d = _digits(m)
    near = F.lower(F.right(before, F.lit(BEFORE)))
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (start + F.length(m)).alias("end"),
        _valid(kind, m).alias("valid"),
        F.least(F.length(d), F.lit(20)).alias("digits"),
        F.least(F.length(F.regexp_replace(m, "[^A-Za-z]+", "")), F.lit(20)).alias("letters"),
        F.least(F.length(F.regexp_replace(m, r"[^\x20().:-]+", "")), F.lit(8)).alias("separators"),
        _side(F.right(before, F.lit(1))).alias("left"), _side(F.left(after, F.lit(1))).alias("right"),
        near.rlike(_POSITIVE).cast("int").alias("cue"), near.rlike(_NEGATIVE).cast("int").alias("doubt"),
        F.when(d == "", 10).otherwise(F.left(d, F.lit(1)).cast("int")).alias("first"),
        F.size(F.array_distinct(F.split(d, ""))).alias("distinct"))


_SHAPE = ("array<struct<start:int,kind:int,end:int,valid:boolean,digits:int,letters:int,separators:int,left:int,right:int,"
          "cue:int,doubt:int,first:int,distinct:int>>")


def _of_kind(kind: str, text: Column) -> Column:
    """Candidates of one kind with their code-point spans: the text between matches gives the places."""
    pattern = PATTERNS[kind]
    none = F.array().cast(_SHAPE)

    def placed(found: Column) -> Column:
        def spans(pieces: Column) -> Column:
            steps = F.transform(found, lambda m, j: F.length(F.get(pieces, j)) + F.coalesce(F.length(F.get(found, j - 1)), F.lit(0)))
            return let(let(steps, _running), lambda starts: F.transform(found, lambda m, j: _candidate(
                kind, m, F.get(pieces, j), F.get(pieces, j + 1), F.get(starts, j))))
        got = let(F.split(text, pattern, -1), spans).cast(_SHAPE)
        if kind == "card":
            got = F.filter(got, lambda c: c["digits"].between(12, 19))
        return F.when(F.size(found) == 0, none).otherwise(got)
    return F.when(text.rlike(_NEEDS[kind]), let(F.regexp_extract_all(text, F.lit(pattern), 0), placed)).otherwise(none)


def candidates(text: Column) -> Column:
    """All proposed spans of a text, by start."""
    return F.sort_array(F.concat(*[_of_kind(k, text) for k in KINDS]))


class Model:
    """Trees and, per kind, the probability from which an invalid candidate is added."""

    def __init__(self, trees: list, limits: dict[int, float]):
        self.trees, self.limits = trees, limits

    def score(self, c: Column) -> Column:
        """Probability of a candidate, rounded down."""
        return F.floor(boosting.probability(self.trees, [c[f] for f in FEATURES]) * SCORES) / SCORES

    def adds(self, c: Column) -> Column:
        wanted = [k for k, v in sorted(self.limits.items()) if v < math.inf]
        if not wanted:
            return F.lit(False)
        p = self.score(c)
        limit = F
        for k in wanted:
            limit = limit.when(c["kind"] == k, F.lit(self.limits[k]))
        return F.coalesce(p >= limit, F.lit(False))


def fit_model(docs: DataFrame, text_col: str = "text", key: Column | None = None, sample_rows: int = 4000,
              vectors: int = 20_000, precision: float = 0.98, prior: float = 10.0) -> Model:
    """Trees from the candidates of about ``sample_rows`` documents (at most twice that) of one half of the texts,
    thresholds from all candidates of the other half.

    For the trees at most ``vectors`` distinct feature vectors, the most frequent, come to the driver, for the
    thresholds the counts of each kind and rounded probability. A kind's threshold is the lowest
    probability whose band of held-out candidates is valid to the share ``precision``
    (:func:`boosting.band_limit`); a kind without such a band gets none and nothing is added to it. Copies of
    a text are in one half."""
    key = F.col(text_col) if key is None else key
    half = F.pmod(F.xxhash64(text_of(text_col), F.lit(13)), F.lit(2))

    def found(rows: DataFrame) -> DataFrame:
        return rows.select(F.explode(candidates(text_of(text_col))).alias("c"))
    counts = [F.count_if("c.valid").alias("pos"), F.count_if(~F.col("c.valid")).alias("neg")]
    fitted = (found(bounded_sample(docs.where(half == 0), key, sample_rows)).groupBy(*[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(*counts)
              .orderBy(F.desc(F.col("pos") + F.col("neg")), *FEATURES).limit(vectors).collect())
    model = Model(boosting.fit([(tuple(r[f] for f in FEATURES), float(r["pos"]), float(r["neg"])) for r in fitted]), {})
    held_out = found(docs.where(half == 1)).groupBy(F.col("c.kind").alias("kind"), model.score(F.col("c")).alias("p")).agg(*counts).collect()
    model.limits = {k: boosting.band_limit([(r["p"], r["pos"], r["neg"]) for r in held_out if r["kind"] == k], precision, prior)
                    for k in range(len(KINDS))}
    return model


def find(docs: DataFrame, model: Model, text_col: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a column ``out`` (replacing one of that name): array of (start, kind, end, valid), by start;
    ``kind`` is a place in KINDS, offsets are code points, end exclusive. Null and empty texts have no spans."""
    kept = F.filter(candidates(text_of(text_col)), lambda c: c["valid"] | model.adds(c))
    spans = F.transform(kept, lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), c["valid"].alias("valid")))
    return docs.select(*[F.col(f"`{c}`") for c in docs.columns if c != out], spans.alias(out))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with its spans replaced by [EMAIL] and so on; spans that overlap are replaced as one, by the first kind."""
    first = F.struct(F.lit(0).alias("from"), F.lit(0).alias("upto"), F.array().cast("array<struct<from:int,upto:int,kind:int>>").alias("parts"))

    def step(s: Column, c: Column) -> Column:
        begins = c["start"] >= s["upto"]
        gap = F.struct(s["upto"].alias("from"), c["start"].alias("upto"), c["kind"].alias("kind"))
        return F.struct(F.lit(0).alias("from"), F.greatest(s["upto"], c["end"]).alias("upto"),
                        F.when(begins, F.array_append(s["parts"], gap)).otherwise(s["parts"]).alias("parts"))
    tags = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def joined(state: Column) -> Column:
        return let(F.split(text, ""), lambda chars: F.concat(
            F.array_join(F.transform(state["parts"], lambda p: F.concat(
                F.array_join(F.slice(chars, p["from"] + 1, p["upto"] - p["from"]), ""), F.get(tags, p["kind"]))), ""),
            F.array_join(F.slice(chars, state["upto"] + 1, F.size(chars)), "")))
    return F.when(F.size(spans) == 0, text).otherwise(let(F.aggregate(spans, first, step), joined))


# ------------------------------------------------------------------------------ query
def _count(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda c: c["kind"] == kind))


def op5_pii(spark, sf_dir):
    """Personal data of every document: base counts and digest, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, fit_model(docs, key=F.col("doc_id")))
    names = F.array(*[F.lit(k) for k in KINDS])

    def written(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"], c["end"])), ",")
    base = F.filter("pii", lambda c: c["valid"])
    counts = [_count("base", i).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return (found.select("doc_id", "pii", base.alias("base"))
            .select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.col("pii")).alias("spans")))
