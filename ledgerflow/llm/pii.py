"""Personal data by weak supervision: labelers vote, EM weighs them, a span
classifier decides.

1. Candidates. Per kind, the strict form (email, ip, card, phone) gives the base
   spans; looser forms give further candidates that overlap no base span.
2. Labelers vote +1, -1 or 0 on each candidate: ``shape`` (does it pass the
   strict form's check), ``gazetteer`` (top-level domains, card issuers, calling
   codes, reserved numbers), ``context`` (cue words before it), ``edges`` (the
   characters beside it).
3. Expectation-maximisation over the counts of (kind, votes) patterns estimates
   each labeler's reliability and each pattern's probability.
4. A logistic classifier on votes, kind and length is trained on those
   probabilities; candidates of 1/2 or more become spans. Base spans always stay.

Everything that touches rows is a DataFrame expression within the row: no
explode of texts, no shuffle but the pattern counts. Only that pattern table,
bounded by kinds x votes x lengths (below 2,000 rows), comes to the driver.

Defined cases: null text is empty and has no spans; every input row gives one
row, repeated or not; null ids stay null; an empty table gives an empty result
and an untrained classifier; other columns are ignored. Offsets count code
points, ends are exclusive.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone", "ssn")
BASE_KINDS = KINDS[:4]
VOTES = ("shape", "gazetteer", "context", "edges")

# Strict forms. Possessive quantifiers and the start conditions change no match;
# they keep the scan linear on long runs of the same class of characters.
STRICT = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser forms, candidates only.
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(]at[\])] ?[A-Za-z0-9-]{1,63}+ ?[\[(]dot[\])] ?[A-Za-z]{2,24}",
    "phone": r"(?<![0-9+(.-])\(?[2-9][0-9]{2}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
# Gazetteers. Fixed lists.
TOP_DOMAINS = ("com|org|net|edu|gov|mil|int|info|biz|io|dev|app|eu|uk|de|fr|es|it|nl|be|ch|at|pl|se|no|dk|fi|pt|ie|"
               "us|ca|mx|br|ar|cl|co|jp|cn|in|kr|au|nz|za|ru")
CALLING_CODES = ("1|7|20|27|30|31|32|33|34|36|39|40|41|43|44|45|46|47|48|49|51|52|53|54|55|56|57|58|60|61|62|63|64|65|"
                 "66|81|82|84|86|90|91|92|93|94|95|98|351|352|353|354|358|420|421|971|972")
CARD_ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|35|6011|62|64|65)"
CUES = {
    "email": r"(?i)(?:e-?mail|mail|contact|write to|courriel|correo)",
    "ip": r"(?i)(?:\bip\b|address|host|server|client|login)",
    "card": r"(?i)(?:card|visa|mastercard|amex|credit|debit|pay|karte|carte|tarjeta)",
    "phone": r"(?i)(?:phone|tel|call|fax|mobile|cell|whatsapp)",
    "ssn": r"(?i)(?:ssn|social security|tax id)",
}
COUNTER_CUES = r"(?i)(?:isbn|version|section|chapter|order|invoice|page|part no|serial)"
WORK = "__pii_"  # prefix of working columns, apart from the names a caller may use
REACH = 32  # code points of context before a candidate
CHUNK = 256


@dataclass(frozen=True)
class Form:
    kind: str
    pattern: str
    strict: bool


FORMS = tuple(Form(k, p, True) for k, p in STRICT.items()) + tuple(Form(k, p, False) for k, p in LOOSE.items())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, as a lambda's variable: what
    a lambda takes from outside is computed anew for each element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running_starts(lengths: Column) -> Column:
    """Sum of the elements before each element, through sums of chunks, so that
    many matches in one long text stay far from quadratic work."""
    zero = F.lit(0)
    total = lambda xs: F.aggregate(xs, zero, lambda a, x: a + x)
    chunk = lambda i: F.floor(i / CHUNK).cast("int")

    def starts(ls: Column, sums: Column) -> Column:
        return F.transform(ls, lambda _, i: F.element_at(sums, chunk(i) + 1)
                           + total(F.slice(ls, chunk(i) * CHUNK + 1, i % CHUNK)))

    def chunk_sums(ls: Column) -> Column:
        each = F.transform(F.sequence(zero, chunk(F.size(ls) - 1)), lambda c: total(F.slice(ls, c * CHUNK + 1, F.lit(CHUNK))))
        return let(each, lambda e: F.transform(e, lambda _, i: total(F.slice(e, F.lit(1), i))))

    return let(lengths, lambda ls: let(chunk_sums(ls), lambda sums: starts(ls, sums)))


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Check sum of the digit string; every second digit from the right doubles."""
    values = F.reverse(F.split(digits, ""))
    doubled = F.transform(values, lambda c, i: let(c.cast("int") * (1 + i % 2), lambda x: F.when(x > 9, x - 9).otherwise(x)))
    return F.aggregate(doubled, F.lit(0), lambda a, x: (a + F.coalesce(x, F.lit(0))).cast("int")) % 10 == 0


def _passes(kind: str, hit: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        # a part without leading zeros has at most three digits and is at most 255
        return F.forall(F.split(hit, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
            r"^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))
    n = F.length(_digits(hit))
    return n.between(9, 15) if kind == "phone" else n.between(12, 19) & _luhn(_digits(hit))


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0)


def _gazetteer(kind: str, hit: Column) -> Column:
    if kind == "email":
        good = hit.rlike(rf"(?i)[. )\]](?:{TOP_DOMAINS})$")
    elif kind == "ip":
        good = ~hit.rlike(r"^(?:0|10|127|22[4-9]|2[3-9][0-9])\.|^169\.254\.|^192\.168\.|^172\.(?:1[6-9]|2[0-9]|3[01])\.")
    elif kind == "card":
        good = _digits(hit).rlike(CARD_ISSUERS)
    elif kind == "ssn":
        good = ~hit.rlike(r"^(?:000|666|9)|-00-|-0000$")
    else:
        good = F.when(hit.startswith("+"), hit.rlike(rf"^\+(?:{CALLING_CODES})")).otherwise(
            _digits(hit).rlike(r"^[2-9][0-9]{2}[2-9]"))
    return _vote(good, ~good)


def _found(text: Column, form: Form) -> Column:
    """Array of structs of one form's matches, null where there is none."""
    def one(hit: Column, gap: Column, following: Column, done: Column) -> Column:
        before, after = F.right(gap, F.lit(REACH)), F.substring(following, 1, 1)
        start = done + F.length(gap)
        ok = _passes(form.kind, hit) if form.strict else F.lit(False)
        shape = F.when(ok, 1).otherwise(-1) if form.strict else F.lit(0)
        glued = F.right(before, F.lit(1)).rlike(r"[\p{L}0-9]") | after.rlike(r"[\p{L}0-9]")
        return F.struct(
            start.cast("int").alias("start"), F.lit(KINDS.index(form.kind)).alias("kind"),
            (start + F.length(hit)).cast("int").alias("end"), ok.alias("base"),
            shape.alias("shape"), _gazetteer(form.kind, hit).alias("gazetteer"),
            _vote(before.rlike(CUES[form.kind]), before.rlike(COUNTER_CUES)).alias("context"),
            _vote(~glued, glued).alias("edges"),
            F.when(F.length(hit) < 8, 0).when(F.length(hit) < 16, 1).otherwise(2).alias("length"))

    def every(hits: Column, gaps: Column) -> Column:
        lengths = F.transform(hits, lambda h, i: F.length(h) + F.length(F.element_at(gaps, i + 1)))
        return let(running_starts(lengths), lambda starts: F.transform(hits, lambda h, i: one(
            h, F.element_at(gaps, i + 1), F.element_at(gaps, i + 2), F.element_at(starts, i + 1))))

    found = let(F.regexp_extract_all(text, F.lit(form.pattern), F.lit(0)),
                lambda hits: let(F.split(text, form.pattern, -1), lambda gaps: every(hits, gaps)))
    # emails need an "@" or a bracket, all other kinds a digit: cheap tests first
    cheap = F.col(WORK + "at") if form.kind == "email" and form.strict else F.col(WORK + "bracket") if form.kind == "email" \
        else F.col(WORK + "digit")
    return F.when(cheap & text.rlike(form.pattern), found)


def with_candidates(documents: DataFrame) -> DataFrame:
    """``documents`` with a column of candidates: per row, the sorted array of candidates."""
    text = text_or_empty()
    d = documents.withColumns({WORK + "digit": text.rlike("[0-9]"), WORK + "at": text.contains("@"),
                               WORK + "bracket": text.rlike(r"[\[(]at[\])]")})
    d = d.withColumns({f"{WORK}form_{i}": _found(text, f) for i, f in enumerate(FORMS)})
    none = F.filter(F.array(F.lit(None).cast(d.schema[WORK + "form_0"].dataType.elementType)), lambda x: F.lit(False))
    forms = F.concat(*[F.coalesce(F.col(f"{WORK}form_{i}"), none) for i in range(len(FORMS))])
    every = WORK + "every"
    d = d.withColumn(every, forms)
    clash = lambda x, b: b["base"] & (b["start"] < x["end"]) & (x["start"] < b["end"])
    kept = let(F.filter(every, lambda b: b["base"]),
               lambda base: F.filter(every, lambda x: x["base"] | ~F.exists(base, lambda b: clash(x, b))))
    loose = F.exists(every, lambda c: ~c["base"])
    return d.withColumn(WORK + "candidates", F.array_sort(F.when(loose, kept).otherwise(F.col(every)))).select(
        *documents.columns, WORK + "candidates")


# --- label model and classifier: plain arithmetic on the pattern table ---------------------------------------------

def patterns(candidates: DataFrame) -> list[tuple[tuple, int]]:
    """((kind, votes..., length), count) over all candidates."""
    keys = ["kind", *VOTES, "length"]
    rows = (candidates.select(F.explode("candidates").alias("c")).select(*[F.col(f"c.{k}").alias(k) for k in keys])
            .groupBy(*keys).count().collect())
    return sorted((tuple(r[k] for k in keys), r["count"]) for r in rows)


def label_model(table: list[tuple[tuple, int]], rounds: int = 50) -> dict[tuple, float]:
    """Probability of each (kind, votes) pattern by expectation-maximisation.

    Votes are independent given the truth; each labeler has one reliability
    table P(vote | truth), each kind a prior. Starts at the majority vote.
    """
    counts: dict[tuple, int] = {}
    for key, n in table:
        counts[key[:-1]] = counts.get(key[:-1], 0) + n
    post = {k: 1 / (1 + math.exp(-1.5 * sum(k[1:]))) for k in counts}
    for _ in range(rounds):
        prior = {}
        for kind in {k[0] for k in counts}:
            mass = [(post[k] * n, n) for k, n in counts.items() if k[0] == kind]
            prior[kind] = (sum(m for m, _ in mass) + 1) / (sum(n for _, n in mass) + 2)
        rates = []
        for j in range(len(VOTES)):
            yes, no = dict.fromkeys((-1, 0, 1), 1.0), dict.fromkeys((-1, 0, 1), 1.0)
            # a mild belief that a labeler's vote agrees with the truth keeps the two classes from swapping
            yes[1] += 2.0
            no[-1] += 2.0
            for k, n in counts.items():
                yes[k[1 + j]] += post[k] * n
                no[k[1 + j]] += (1 - post[k]) * n
            rates.append(({v: x / sum(yes.values()) for v, x in yes.items()}, {v: x / sum(no.values()) for v, x in no.items()}))
        for k in counts:
            odds = math.log(prior[k[0]] / (1 - prior[k[0]]))
            odds += sum(math.log(rates[j][0][k[1 + j]] / rates[j][1][k[1 + j]]) for j in range(len(VOTES)))
            post[k] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return post


def _features(key: tuple) -> list[float]:
    kind, *votes, length = key
    return [1.0, *map(float, votes), *[float(kind == i) for i in range(len(KINDS))], float(length == 0), float(length == 2)]


def train(table: list[tuple[tuple, int]], rounds: int = 500, rate: float = 0.5, shrink: float = 1e-3) -> list[float]:
    """Weights of the span classifier, fitted to the label model's probabilities."""
    post = label_model(table)
    rows = [(_features(k), post[k[:-1]], n) for k, n in table]
    weights = [0.0] * (1 + len(VOTES) + len(KINDS) + 2)
    total = sum(n for _, _, n in rows) or 1
    for _ in range(rounds if rows else 0):
        grad = [shrink * w for w in weights]
        for x, p, n in rows:
            q = 1 / (1 + math.exp(-max(-30.0, min(30.0, sum(a * b for a, b in zip(weights, x, strict=True))))))
            for i, a in enumerate(x):
                grad[i] += (q - p) * n / total * a
        weights = [w - rate * g for w, g in zip(weights, grad, strict=True)]
    return weights


def accepted(candidates: Column, weights: list[float]) -> Column:
    """Base spans and the candidates that the classifier gives 1/2 or more."""
    bias, rest = weights[0], weights[1:]

    def odds(c: Column) -> Column:
        out = F.lit(bias)
        for w, v in zip(rest, VOTES, strict=False):
            out = out + c[v] * w
        for i, w in enumerate(rest[len(VOTES):len(VOTES) + len(KINDS)]):
            out = out + F.when(c["kind"] == i, w).otherwise(0.0)
        return out + F.when(c["length"] == 0, rest[-2]).when(c["length"] == 2, rest[-1]).otherwise(0.0)

    return F.filter(candidates, lambda c: c["base"] | ((odds(c) >= 0) & F.lit(any(weights))))


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(
        ":", F.element_at(names, c["kind"] + 1), c["start"].cast("string"), c["end"].cast("string"))), ",")


def find(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = with_candidates(documents.select("doc_id", "text"))
    rows = stored(found.select("doc_id", F.col(WORK + "candidates").alias("candidates")), "pii_candidates")
    weights = train(patterns(rows))
    base = F.filter("candidates", lambda c: c["base"])
    n = lambda k: F.size(F.filter("candidates", lambda c: c["base"] & (c["kind"] == KINDS.index(k)))).cast("long")
    return rows.select("doc_id", *[n(k).alias(f"n_{k}") for k in BASE_KINDS],
                       F.sha2(_listed(base), 256).alias("base_sha256"),
                       _listed(accepted(F.col("candidates"), weights)).alias("spans"))


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with every span in ``text`` replaced by its kind in brackets.

    Overlapping spans are replaced together, under the first one's kind.
    """
    found = with_candidates(documents)
    weights = train(patterns(found.select(F.col(WORK + "candidates").alias("candidates"))))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    text = F.col("text")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, c: Column) -> Column:
        apart = c["start"] >= acc["at"]
        parts = F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, c["start"] - acc["at"]),
                                               F.element_at(names, c["kind"] + 1)))
        return F.struct(F.greatest(acc["at"], c["end"]).alias("at"), F.when(apart, parts).otherwise(acc["parts"]).alias("parts"))

    masked = F.aggregate(WORK + "spans", start, step,
                         lambda acc: F.concat(F.array_join(acc["parts"], ""),
                                              F.substring(text, acc["at"] + 1, F.length(text))))
    return (found.withColumn(WORK + "spans", accepted(F.col(WORK + "candidates"), weights))
            .withColumn("text", F.when(F.size(WORK + "spans") > 0, masked).otherwise(text))
            .select(*documents.columns))
