"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Built from SQL functions alone. For each kind a pattern proposes leftmost,
non-overlapping matches; the lengths of the gaps between them (``split`` by the
same pattern) give their places in code points. A kind's check drops what fails
it: parts of an IP address, Luhn for cards, the number of digits of a phone
number, mod 97 for IBANs. A confirmed span has its kind's score, raised if one of
the kind's words stands nearby. The four base kinds are kept at any score; a span
of another kind is kept from ``threshold`` on, so a phone number without country
code needs such a word.

Patterns start a match only where a run of its characters begins (or the last
match ended) and don't give back what they took. That finds the same matches and
takes time in proportion to the text also where it holds very long runs.

Defined cases. A null or empty text has no spans. Repeated rows are handled one
by one. An empty table gives an empty result. Columns of the input with the
names of the columns added here are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from authorlink.llm import common

#: From this score on, a span of a kind that is not a base kind is kept.
THRESHOLD = 0.5
#: What a word nearby adds, and how many code points before and after a span are searched for it.
BOOST, BEFORE, AFTER = 0.3, 48, 24
#: Least code points of a match of any kind.
SHORTEST = 2


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes Luhn's check: every second digit from the right counts double."""
    values = F.transform(
        F.sequence(F.lit(1), F.length(digits)),
        lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, F.lit(2)).otherwise(F.lit(1)),
    )
    total = F.aggregate(values, F.lit(0), lambda total, v: total + F.when(v > 9, v - 9).otherwise(v))
    return total % 10 == 0


def mod97(account: Column) -> Column:
    """Whether letters and digits, the first four moved to the end, letters as 10 to 35, leave 1 modulo 97."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, F.lit(1))))
    rest = F.aggregate(
        signs,
        F.lit(0),
        lambda rest, sign: F.when(sign >= 65, (rest * 100 + sign - 55) % 97).otherwise((rest * 10 + sign - 48) % 97),
    )
    return rest == 1


def _card(match: Column) -> Column:
    digits = _digits(match)
    return F.length(digits).between(14, 19) & luhn(digits)


def _ip(match: Column) -> Column:
    # Leading zeros aside, a part of over three digits is above 255.
    parts = F.transform(F.split(match, r"\."), lambda part: F.ltrim(part, F.lit("0")))
    return F.forall(parts, lambda part: (F.length(part) <= 3) & (F.lpad(part, 3, "0") <= "255"))


def _phone(match: Column) -> Column:
    return F.length(_digits(match)).between(10, 15)


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    words: tuple[str, ...]
    base: bool = True
    needs: str = ""


_MAIL = "A-Za-z0-9._%+-"
#: In the order in which spans with the same start are listed.
KINDS = (
    Kind("email", rf"(?:(?<![{_MAIL}])|\G)[{_MAIL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", lambda m: F.lit(True), 0.6,
         ("mail", "email", "e-mail", "contact", "write"), needs="@"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", _ip, 0.4, ("ip", "host", "server", "address", "login"), needs="."),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", _card, 0.6, ("card", "visa", "mastercard", "amex", "credit", "payment")),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _phone, 0.5, ("phone", "tel", "call", "mobile", "fax"), needs="+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
         lambda m: mod97(F.regexp_replace(m, " ", "")), 0.6, ("iban", "account", "bank", "transfer"), base=False),
    Kind("local_phone", r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])",
         lambda m: F.lit(True), 0.25, ("phone", "tel", "call", "mobile", "fax"), base=False),
)


def _proposed(text: Column, kind: Kind) -> Column:
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    return F.when(F.contains(text, F.lit(kind.needs)), found) if kind.needs else found


_SPAN = "array<struct<start:int,order:int,end:int,match:string,near:string>>"


def _placed(matches: Column, gaps: Column, kind: Kind) -> Column:
    """Confirmed matches with their places, and the text before and after them, other matches included."""
    empty = F.array().cast(_SPAN)
    # So many matches have AFTER code points, or the text ends sooner.
    ahead = -(-AFTER // SHORTEST)

    def step(state: Column, i: Column) -> Column:
        gap, match = F.get(gaps, i), F.get(matches, i)
        start = state["at"] + F.length(gap)
        end = start + F.length(match)
        before = F.substring(F.concat(state["before"], F.substring(gap, -BEFORE, BEFORE)), -BEFORE, BEFORE)
        following = F.zip_with(
            F.slice(gaps, i + 2, ahead),
            F.slice(matches, i + 2, ahead),
            lambda g, m: F.concat_ws("", F.substring(g, 1, AFTER), F.substring(m, 1, AFTER)),
        )
        near = F.concat(before, F.lit("\n"), F.substring(F.concat_ws("", following), 1, AFTER))
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("order"),
            end.alias("end"),
            match.alias("match"),
            F.lower(near).alias("near"),
        )
        passed = F.substring(F.concat(before, F.substring(match, -BEFORE, BEFORE)), -BEFORE, BEFORE)
        return F.struct(end.alias("at"), passed.alias("before"), F.concat(state["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("before"), empty.alias("spans"))
    places = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), first, step)["spans"]
    return F.when(F.size(matches) > 0, F.filter(places, lambda span: kind.confirmed(span["match"]))).otherwise(empty)


def _score(span: Column) -> Column:
    score = F.lit(0.0)
    for order, kind in enumerate(KINDS):
        words = "|".join(kind.words)
        nearby = F.rlike(span["near"], F.lit(rf"(?<![a-z])(?:{words})(?![a-z])"))
        raised = F.when(nearby, F.lit(BOOST)).otherwise(F.lit(0.0))
        score = F.when(span["order"] == order, F.lit(kind.score) + raised).otherwise(score)
    return score


def detect(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with ``pii``: spans ``(start, order, end, kind, score)``, by start and then kind."""
    out = docs.drop("pii").withColumn("_text", common.text_or_empty())
    for kind in KINDS:
        out = out.withColumn(f"_match_{kind.name}", _proposed(F.col("_text"), kind))
    # Columns of their own, so that a text is cut once and not again for each match.
    for kind in KINDS:
        match = F.col(f"_match_{kind.name}")
        out = out.withColumn(f"_gaps_{kind.name}", F.when(F.size(match) > 0, F.split("_text", kind.pattern, -1)))
    spans = [_placed(F.col(f"_match_{kind.name}"), F.col(f"_gaps_{kind.name}"), kind) for kind in KINDS]
    out = out.withColumn("_spans", F.concat(*(F.coalesce(span, F.array().cast(_SPAN)) for span in spans)))
    names = F.array(*(F.lit(kind.name) for kind in KINDS))
    n_base = sum(kind.base for kind in KINDS)
    scored = F.transform(
        "_spans",
        lambda span: F.struct(
            span["start"].alias("start"),
            span["order"].alias("order"),
            span["end"].alias("end"),
            F.get(names, span["order"]).alias("kind"),
            _score(span).alias("score"),
        ),
    )
    kept = F.filter(F.array_sort(scored), lambda span: (span["order"] < n_base) | (span["score"] >= threshold))
    own = [c for c in out.columns if c in ("_text", "_spans") or c.startswith(("_match_", "_gaps_"))]
    return out.withColumn("pii", kept).drop(*own)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents with every span in ``text`` replaced by its kind in angle brackets, and ``n_chars`` to fit.

    Of spans that overlap the one with the earlier start names the mark, and the
    mark covers all of them.
    """

    def step(state: Column, span: Column) -> Column:
        text = F.col("text")
        clear = F.substring(text, state["at"] + 1, F.greatest(span["start"] - state["at"], F.lit(0)))
        mark = F.when(span["start"] >= state["at"], F.concat(F.lit("<"), span["kind"], F.lit(">"))).otherwise(F.lit(""))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["done"], clear, mark).alias("done")
        )

    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))
    columns = docs.columns
    found = detect(docs.withColumnRenamed("pii", "_own_pii"), threshold)
    found = found.withColumn("_redacted", F.when(F.size("pii") > 0, F.aggregate("pii", first, step)))
    rest = F.substring(F.col("text"), F.col("_redacted.at") + 1, F.length("text"))
    text = F.when(F.col("_redacted").isNull(), F.col("text")).otherwise(F.concat(F.col("_redacted.done"), rest))
    out = found.withColumn("text", text).drop("pii", "_redacted").withColumnRenamed("_own_pii", "pii")
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(common.read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [kind.name for kind in KINDS if kind.base]
    of_base = F.filter("pii", lambda s: s["order"] < len(base))
    kinds = F.transform("pii", lambda s: s["kind"])
    counts = [(F.size("pii") - F.size(F.array_remove(kinds, name))).cast("long").alias(f"n_{name}") for name in base]
    return found.select(
        "doc_id", *counts, F.sha2(listed(of_base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans")
    )
