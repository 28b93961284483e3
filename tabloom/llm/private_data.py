"""Personal data, and the terms that give it away, found and sanitised.

Base entities (emails, addresses, cards, phones) are found by patterns. How strongly a term
reveals an entity is estimated from the corpus: terms within ``near`` words of an entity are
counted with it, and all their occurrences are counted in the whole corpus. The disclosure of
term t about entity e is PMI(t, e) / IC(e) = 1 + log2 p(e|t) / IC(e): 1 if t never stands
anywhere else. For p(e|t) stands a lower bound, ``errors`` standard errors down (Wilson's), of
the different surroundings that t has with e (copies of one text count once) among those and all
other occurrences of t. So an entity that stands once can be judged, and little evidence counts
as little: one surrounding of a term that stands nowhere else gives 1 - 3.3 bits / IC. A term is
generalised from ``generalise`` on and removed from ``remove`` on: with ``everywhere`` in all
documents, since the term alone discloses the entity, else in those that hold the entity. Surroundings are whole words; what is glued to the entity is none.

DataFrame operations only. Spans come from matches and the pieces between them, whose lengths
add up to positions in code points. Words and (entity, term) rows are summed before they are
shuffled; texts meet their terms in one join.

Defined results: a null or empty text has no spans; a null id stays null; rows repeated with
the same id and text get equal results each. Of overlapping spans, the text is cut from the
first start to the last end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabloom.llm.mixing import WORD, n_words
from tabloom.workspace import stage

KINDS = ("email", "ip", "card", "phone", "term")

# The contract's patterns, with possessive parts where a match can't be lost by them, and a look
# behind or at the last match's end, so that long runs are tried once and not from every place.
_LOCAL = "A-Za-z0-9._%+-"
_PATTERNS = {
    "email": rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_BYTE = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"


def _holds(kind: str, match: Column) -> Column:
    """Whether a match of the pattern of ``kind`` counts."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda part: part.rlike(_BYTE))
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), F.call_function("luhn_check", digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(10, 15)
    return F.lit(True)


def _placed(text: Column, pattern: str, keep, number: int) -> Column:
    """Kept matches with their places: array of (start, kind, end, value)."""
    shape = "array<struct<start:int,kind:int,end:int,value:string>>"
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
    )

    def step(held, piece):
        start = held["at"] + F.length(piece["gap"])
        end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
        span = F.struct(
            start.alias("start"),
            F.lit(number).alias("kind"),
            end.alias("end"),
            piece["match"].alias("value"),
        )
        found = F.when(
            piece["match"].isNotNull() & keep(piece["match"]),
            F.concat(held["spans"], F.array(span)),
        ).otherwise(held["spans"])
        return F.struct(end.alias("at"), found.alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(shape).alias("spans"))
    return F.aggregate(pieces, begin, step, lambda held: held["spans"])


def base_spans(text: Column) -> Column:
    """Spans of base entities by start, then kind: array of (start, kind, end, value)."""
    text = F.coalesce(text, F.lit(""))
    found = [
        F.when(
            text.rlike("@" if kind == "email" else "[0-9]"),
            _placed(text, pattern, lambda m, k=kind: _holds(k, m), i),
        ).otherwise(F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>"))
        for i, (kind, pattern) in enumerate(_PATTERNS.items())
    ]
    return F.array_sort(F.concat(*found))


def described(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


# What stands beside an entity, after the rest of its own word: anchored, so that it is linear.
_SPACE, _BLACK = r"[\x20\x09-\x0D]", r"[^\x20\x09-\x0D]"


def _words(text: Column) -> Column:
    return F.regexp_extract_all(_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


# Characters beside an entity that are looked at first.
_WINDOW = 2000


def _beside(close: Column, whole: Column, near: int) -> Column:
    """The first ``near`` whole words beside an entity, but for what is glued to it.

    ``close`` is as much of ``whole`` as usually holds them; the rest is read only where words are
    so long that it does not.
    """
    word = f"{_SPACE}++{_BLACK}++"
    found = F.regexp_extract(close, f"^{_BLACK}*+((?:{word}){{{near}}}){_SPACE}", 1)
    some = F.regexp_extract(whole, f"^{_BLACK}*+((?:{word}){{0,{near}}})", 1)
    return _words(F.when(found != "", found).otherwise(some))


def _around(text: Column, span: Column, near: int) -> Column:
    """Words before and after a span."""
    start, end = span["start"], span["end"]
    first = F.greatest(start - _WINDOW, F.lit(0))
    before = F.reverse(F.substring(text, first + 1, start - first))
    after = F.substring(text, end + 1, F.lit(_WINDOW))
    all_before = F.reverse(F.substring(text, F.lit(1), start))
    all_after = F.substring(text, end + 1, F.length(text))
    return F.concat(
        F.transform(_beside(before, all_before, near), lambda w: F.reverse(w)),
        _beside(after, all_after, near),
    )


def _lower_bound(hits: Column, trials: Column, z: float) -> Column:
    """Wilson's lower bound, ``z`` standard errors down, of a share seen as ``hits`` of ``trials``."""
    spread = F.sqrt(hits * (trials - hits) / trials + z * z / 4)
    return (hits + z * z / 2 - z * spread) / (trials + z * z)


def revealing_terms(
    found: DataFrame,
    docs: DataFrame,
    near: int = 5,
    errors: float = 3.0,
    generalise: float = 0.8,
) -> DataFrame:
    """``(kind, value, term, disclosure, elsewhere)`` of the terms that give entities away.

    ``found`` has distinct texts (``_row``, ``_times``) with their base ``spans``; ``docs`` is the
    whole corpus. ``elsewhere``: whether the term may stand where the entity doesn't.
    """
    text = F.col("text")
    places = found.select("_row", "_times", "text", F.explode("spans").alias("span")).select(
        "_row",
        "_times",
        F.col("span.kind").alias("kind"),
        F.col("span.value").alias("value"),
        _around(text, F.col("span"), near).alias("_around"),
    )
    # Written, since three sums are made of it.
    places = stage(places.withColumn("_context", F.xxhash64("_around")), "places")
    entities = (
        places.select("kind", "value", "_context")
        .distinct()
        .groupBy("kind", "value")
        .agg(F.count(F.lit(1)).alias("n_entity"))
    )
    near_words = places.select(
        "*", F.explode(F.array_distinct("_around")).alias("term")
    ).withColumn("n", F.size(F.filter("_around", lambda w: w == F.col("term"))) * F.col("_times"))
    contexts = (
        near_words.select("kind", "value", "term", "_context")
        .distinct()
        .groupBy("kind", "value", "term")
        .agg(F.count(F.lit(1)).alias("n_contexts"))
    )
    # A word near two mentions counts once, so that no more are counted than there are.
    beside = (
        near_words.groupBy("kind", "value", "term", "_row")
        .agg(F.max("n").alias("n"))
        .groupBy("kind", "value", "term")
        .agg(F.sum("n").alias("n_both"))
    )
    together = stage(contexts.join(beside, ["kind", "value", "term"]), "terms")
    # Summed before the join: most words of the corpus may be candidates.
    totals = (
        docs.select(F.explode(_words(text)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("n_term"))
        .join(together.select("term").distinct(), "term", "left_semi")
    )
    size = docs.agg(F.greatest(F.sum(n_words(text)), F.lit(2)).alias("n_all"))
    others = F.col("n_term") - F.col("n_both")
    share = _lower_bound(F.col("n_contexts"), F.col("n_contexts") + others, errors)
    # PMI over IC, with log2 of the share of the term's occurrences that reveal the entity.
    ic = F.log2(F.col("n_all") / F.col("n_entity"))
    return (
        together.join(totals, "term")
        .join(entities, ["kind", "value"])
        .withColumn("n_all", F.lit(size.head()[0] or 2))
        .select(
            "kind",
            "value",
            "term",
            (1 + F.try_divide(F.log2(share), ic)).alias("disclosure"),
            (others > 0).alias("elsewhere"),
        )
        .filter(F.col("disclosure") >= generalise)
    )


def sanitise(
    docs: DataFrame,
    near: int = 5,
    errors: float = 3.0,
    generalise: float = 0.8,
    remove: float = 0.95,
    everywhere: bool = False,
) -> DataFrame:
    """All columns of ``docs``, with ``spans`` (array of start, kind, end, value).

    Kinds are numbered as in ``KINDS``. Terms have kind 4, and as value what replaces them. A
    column ``spans`` of ``docs`` gives way to these.
    ``everywhere``: replace terms in all documents, and not in those that hold the entity only.
    """
    row = F.xxhash64(F.col("doc_id"), F.col("text"))
    based = docs.select("doc_id", "text").withColumn("spans", base_spans(F.col("text")))
    # Copies under different ids are different occurrences; equal rows are one here.
    found = stage(
        based.filter(F.size("spans") > 0)
        .withColumn("_row", row)
        .groupBy("_row")
        .agg(
            F.first("text").alias("text"),
            F.first("spans").alias("spans"),
            F.count(F.lit(1)).alias("_times"),
        ),
        "entities",
    )
    terms = stage(revealing_terms(found, docs, near, errors, generalise), "revealing")
    held = (
        found.select("_row", F.explode("spans").alias("s"))
        .select("_row", F.col("s.kind").alias("kind"), F.col("s.value").alias("value"))
        .distinct()
        .join(terms, ["kind", "value"])
        .select("_row", "term", "disclosure")
    )
    if everywhere:
        # Written, so that its size decides between a broadcast and a shuffle.
        spread = stage(
            terms.filter("elsewhere").groupBy("term").agg(F.max("disclosure").alias("disclosure")),
            "spread",
        )
        words = docs.select(
            row.alias("_row"), F.explode(F.array_distinct(_words(F.col("text")))).alias("term")
        )
        held = held.union(words.join(spread, "term").select("_row", "term", "disclosure"))
    by_row = stage(
        held.groupBy("_row", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .groupBy("_row")
        .agg(
            F.map_from_entries(
                F.collect_list(
                    F.struct(
                        "term",
                        F.when(F.col("disclosure") >= remove, "").otherwise("[TERM]"),
                    )
                )
            ).alias("_terms")
        ),
        "terms-of-rows",
    )
    placed = _placed(
        F.col("text"),
        WORD,
        lambda m: F.map_contains_key(F.col("_terms"), _lower(m)),
        KINDS.index("term"),
    )
    free = F.filter(
        placed,
        lambda t: ~F.exists("spans", lambda s: (s["start"] < t["end"]) & (t["start"] < s["end"])),
    )
    named = F.transform(free, lambda t: t.withField("value", F.col("_terms")[_lower(t["value"])]))
    kept = [c for c in docs.columns if c != "spans"]
    packed = docs.select(
        row.alias("_row"),
        "text",
        base_spans(F.col("text")).alias("spans"),
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_rest"),
    )
    whole = F.when(F.col("_terms").isNotNull(), F.array_sort(F.concat("spans", named)))
    joined = packed.join(by_row, "_row", "left")
    return joined.select("_rest", whole.otherwise(F.col("spans")).alias("spans")).select("_rest.*", "spans")


def cleaned(text: Column, spans: Column) -> Column:
    """The text with entities replaced by their kind, and terms by what replaces them."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def step(held, s):
        start = F.greatest(s["start"], held["at"])
        between = F.substring(text, held["at"] + 1, start - held["at"])
        instead = F.when(s["kind"] == KINDS.index("term"), s["value"]).otherwise(
            F.get(names, s["kind"])
        )
        instead = F.when(s["start"] < held["at"], "").otherwise(instead)
        return F.struct(
            F.greatest(s["end"], held["at"]).alias("at"),
            F.concat(held["out"], between, instead).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda held: F.concat(
        held["out"], F.substring(text, held["at"] + 1, F.length(text) - held["at"])
    )
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, rest)).otherwise(text)


def counted(spans: Column) -> list[Column]:
    """n_email, n_ip, n_card, n_phone."""

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return [count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS[:4])]
