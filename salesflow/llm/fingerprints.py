"""I-Match document fingerprints, in DataFrame functions only.

The lexicon holds the terms whose document frequency lies in a band (so inverse document
frequency does); each is given, by its hash, to some of several randomised lexicon subsets,
which hold from a half down to a 65536th of it. A document's distinct terms are looked up,
and a subset's signature is the sum of the hashes of its terms: like hashing the sorted
terms it depends on the set alone, and it is added up before the shuffle. A signature
counts where the subset holds one to ``MOST_TERMS`` terms of the document, so that texts of
every length have some subsets that are neither empty nor sure to change with an edit.

The band's lower end is a share of all documents, so the lexicon has at most (mean distinct
terms per document / share) terms, however many documents there are; its size is checked
before it is broadcast.

Texts without a counting signature get a hash of the whole text instead, which is alike
only to an equal text's. Null text is empty. Repeated rows get equal fingerprints. Empty
tables give no rows; columns other than the named ones are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesflow.session import cut

LEAST_SHARE = 0.0005
LEAST_DOCUMENTS = 2
MOST_SHARE = 0.2
#: Share of the lexicon in each subset, as powers of 1/2; the thinnest are for texts of some 100,000 terms.
SUBSETS = (*(level for level in range(1, 13) for _ in range(3)), 13, 14, 15, 15, 16, 16)
MOST_TERMS = 4
_COUNT = 42
BROADCAST_TERMS = 2_000_000
ROWS_PER_RANGE = 2000


def _term_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per distinct term of a text and one with the empty term, terms as hashes."""
    runs = F.split(F.lower(text), r"[^\p{L}\p{N}]+")
    words = F.array_distinct(F.concat(F.array(F.lit("")), runs))
    return df.select(*keep, F.explode(words).alias("word")).select(
        *keep, F.xxhash64("word").alias("term")
    )


def lexicon(
    df: DataFrame,
    text: str = "text",
    least_share: float = LEAST_SHARE,
    least: int = LEAST_DOCUMENTS,
    most_share: float = MOST_SHARE,
) -> DataFrame:
    """(term, member): hashes of the terms in the band and their subsets, one bit each.

    The empty term is there without a subset: it keeps texts that have no other term.
    """
    texts = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    documents = df.count()
    low = max(least, least_share * documents)
    high = max(low, most_share * documents)
    nothing = F.xxhash64(F.lit(""))
    band = (
        _term_rows(texts, "text")
        .where(F.col("term") != nothing)
        .groupBy("term")
        .count()
        .where((F.col("count") >= low) & (F.col("count") <= high))
    )
    chosen = [
        F.when(F.xxhash64("term", F.lit(k)).bitwiseAND((1 << level) - 1) == 0, 1 << k).otherwise(F.lit(0).cast("bigint"))
        for k, level in enumerate(SUBSETS)
    ]
    member = reduce(lambda a, b: a + b, chosen).cast("bigint").alias("member")
    empty = df.sparkSession.range(1).select(nothing.alias("term"), F.lit(0).cast("bigint").alias("member"))
    return cut(band.select("term", member).union(empty))


def fingerprints(
    df: DataFrame, lexicon: DataFrame, keys: list[str], texts: dict[str, str]
) -> DataFrame:
    """(keys, kind, fingerprint): one row per row of ``df`` and entry of ``texts`` (kind: column).

    ``keys`` tell the rows apart. A fingerprint is the subsets' signatures in hexadecimal,
    ``-`` where one does not count, or ``text:`` and a hash.
    """
    side = F.broadcast(lexicon) if lexicon.count() <= BROADCAST_TERMS else lexicon
    pairs = F.array(
        *[F.struct(F.lit(n).alias("kind"), F.col(t).alias("body")) for n, t in texts.items()]
    )
    rows = df.select(*keys, F.explode(pairs).alias("pair")).select(
        *keys, "pair.kind", "pair.body", F.xxhash64("pair.body").alias("whole")
    )
    found = _term_rows(rows, "body", *keys, "kind", "whole").join(side, "term")
    # The number of terms above, their hashes' sum below; far too many terms give null.
    mark = F.lit(1 << _COUNT) + F.shiftrightunsigned(F.xxhash64("term", F.lit("mark")), 26)
    sums = [
        F.try_sum(F.when(F.col("member").bitwiseAND(1 << k) != 0, mark)).alias(f"s{k}")
        for k in range(len(SUBSETS))
    ]
    counted = found.groupBy(*keys, "kind", "whole").agg(*sums)
    signs = [
        F.when(F.shiftright(f"s{k}", _COUNT) <= MOST_TERMS, F.lower(F.hex(f"s{k}")))
        for k in range(len(SUBSETS))
    ]
    nothing = reduce(lambda a, b: a & b, [s.isNull() for s in signs])
    return counted.select(
        *keys,
        "kind",
        F.when(nothing, F.concat(F.lit("text:"), F.lower(F.hex("whole"))))
        .otherwise(F.concat_ws(".", *[F.coalesce(s, F.lit("-")) for s in signs]))
        .alias("fingerprint"),
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal signatures among the subsets that count for either; 1 for equal fingerprints."""
    left, right = F.split(a, r"\."), F.split(b, r"\.")
    pairs = F.arrays_zip(left.alias("x"), right.alias("y"))
    some = F.filter(pairs, lambda p: (p["x"] != "-") | (p["y"] != "-"))
    same = F.filter(some, lambda p: p["x"] == p["y"])
    return F.when(a == b, 1.0).otherwise(F.coalesce(F.size(same) / F.size(some), F.lit(0.0))).cast("double")


def _bucket(cuts: list[int], id: Column) -> Column:
    """How many of the sorted cuts are at most the id; looked up in two steps."""
    step = max(1, math.isqrt(len(cuts)))
    firsts = cuts[::step]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda c: c <= id))

    part = below(F.array(*[F.lit(c) for c in firsts]))
    chunks = F.array(*[F.array(*[F.lit(c) for c in cuts[k : k + step]]) for k in range(0, len(cuts), step)])
    return F.when(part == 0, 0).otherwise((part - 1) * step + below(F.element_at(chunks, F.greatest(part, F.lit(1)))))


def with_next(df: DataFrame, id: str, text: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(id, text, at, next_at, next_text): every row and its successor in ascending id.

    Ids are cut at some of their own values into ranges of about ``rows_per_range`` rows.
    The row at a cut goes to its own range and, as a guest, to the end of the range before;
    the first of all is the guest of the last range. So each range is sorted on its own.
    ``at`` names a row. Null ids come last; equal ids are ordered by text.
    """
    rows = df.select(F.col(id).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total, least = rows.agg(F.count(F.lit(1)), F.min("id")).first()
    ranges = max(1, math.ceil(total / rows_per_range))
    cuts: list[int] = []
    if ranges > 1 and least is not None:
        shares = [k / ranges for k in range(1, ranges)]
        found = rows.agg(F.percentile_approx("id", shares, max(10_000, 20 * ranges))).first()[0]
        cuts = sorted({c for c in found if c > least})
    last = len(cuts)
    if cuts:
        home = F.when(F.col("id").isNull(), last).otherwise(_bucket(cuts, F.col("id")))
        at_cut = F.array(*[F.lit(c) for c in [least, *cuts]])[F.col("home")] == F.col("id")
    else:
        home = F.lit(0)
        at_cut = F.col("id") == F.lit(least).cast("bigint")

    def place(where, guest: bool) -> Column:
        return F.struct(where.cast("int").alias("range"), F.lit(guest).alias("guest"))

    before = F.when(F.col("home") == 0, last).otherwise(F.col("home") - 1)
    own = place(F.col("home"), False)
    places = F.when(at_cut, F.array(own, place(before, True))).otherwise(F.array(own))
    spread = rows.withColumn("home", home.cast("int")).select("id", "text", "home", F.explode(places).alias("p"))
    order = Window.partitionBy("range").orderBy("guest", F.col("id").asc_nulls_last(), "text")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    number = F.row_number().over(order)
    following = F.lead(F.struct("home", "guest")).over(order)
    numbered = spread.select("id", "text", "home", "p.range", "p.guest").select(
        "id",
        "text",
        "guest",
        F.struct(F.col("range").alias("range"), number.alias("row")).alias("at"),
        F.when(following["guest"], F.struct(following["home"].alias("range"), F.lit(1).alias("row")))
        .when(following.isNotNull(), F.struct(F.col("range").alias("range"), (number + 1).alias("row")))
        # Only a table without any id has no guest.
        .otherwise(F.struct(F.lit(0).alias("range"), F.lit(1).alias("row")))
        .alias("next_at"),
        F.lead("text").over(order).alias("following") if least is not None
        else F.coalesce(F.lead("text").over(order), F.first("text").over(whole)).alias("following"),
    )
    return numbered.where(~F.col("guest")).select(
        "id", "text", "at", "next_at", F.col("following").alias("next_text")
    )


def compared(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and of their edited forms, and how alike they and their successors' are.

    The edited text has its last quarter of code points replaced by the first as many of the
    next text.
    """
    words = lexicon(df, text)
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - quarter), F.substring("next_text", F.lit(1), quarter)
    )
    rows = (
        with_next(df, id, text)
        .select("id", "text", "at", "next_at", n.cast("bigint").alias("n_chars"), edited.alias("edited"))
        .withColumn("edited_sha256", F.sha2("edited", 256))
    )
    keys = ["at", "next_at", "id", "n_chars", "edited_sha256"]
    found = cut(fingerprints(rows, words, keys, {"own": "text", "edited": "edited"}))
    own = found.where(F.col("kind") == "own").select("at", F.col("fingerprint").alias("own"), "next_at", "id", "n_chars", "edited_sha256")
    changed = found.where(F.col("kind") == "edited").select("at", F.col("fingerprint").alias("changed"))
    following = own.select(F.col("at").alias("next_at"), F.col("own").alias("next_own"))
    return (
        own.join(changed, "at")
        .join(following, "next_at")
        .select(
            F.col("id").alias(id),
            "n_chars",
            "edited_sha256",
            F.col("own").alias("fingerprint"),
            F.col("changed").alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), F.col("next_own")).alias("near_next"),
        )
    )
