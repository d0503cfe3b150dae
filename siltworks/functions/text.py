"""Column expressions on text; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns: whitespace in the Unicode sense (plus the four separators that
# Python strips too), and tokens of two or more word characters.
BLANK = r"(?U)^[\s\x1c-\x1f]*$"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def is_blank(text: Column) -> Column:
    return text.rlike(BLANK)


def fingerprint(text: Column) -> Column:
    """32-byte content key, so that shuffles carry a hash instead of the text."""
    return F.unhex(F.sha2(text, 256))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def bigrams(words: Column) -> Column:
    return F.when(F.size(words) < 2, F.array().cast("array<string>")).otherwise(
        F.zip_with(
            F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
            F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
            # no word is null; in a lambda this costs half of what concat_ws does
            lambda left, right: F.concat(left, F.lit(" "), right),
        )
    )


def term_counts(terms: Column) -> Column:
    """``array<term>`` -> ``array<struct(term, tf)>`` inside the row.

    Sorting the row's own terms and cutting the run starts keeps the count free
    of any (row, term) shuffle.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), size - 1),
            # nothing is null but what lies before the first term
            lambda i: ~F.get(ordered, i).eqNullSafe(F.get(ordered, i - 1)),
        )
        return F.transform(
            F.transform(F.array(starts), lambda s: F.struct(s.alias("at"), F.concat(F.slice(s, 2, size), F.array(size)).alias("end"))),
            lambda pair: F.zip_with(
                pair["at"],
                pair["end"],
                lambda a, b: F.struct(F.get(ordered, a).alias("term"), (b - a).cast("long").alias("tf")),
            ),
        )[0]

    empty = F.array().cast("array<struct<term:string,tf:bigint>>")
    counted = F.transform(F.array(F.sort_array(terms)), runs)[0]
    return F.when(F.size(terms) > 0, counted).otherwise(empty)
