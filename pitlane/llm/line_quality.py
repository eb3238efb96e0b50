"""Quality rules: base rules of one text, and the frequency of its lines across a host's documents.

Lines are normalised and hashed, distinct documents are counted per (host,
line), lines above both limits are taken out of a text, and a document that
loses more than half of its words so is rejected. ``source`` is the host.

For a line, a document counts by its longest other line, or by the line itself
where it has no other. So copies, and copies edited elsewhere, count as one, and
a group of copies isn't taken for boilerplate; a long notice in documents that
differ counts once for each. A host's documents count by their two longest
lines. What is compared in hashes is 64 bits wide: a line is wrongly taken out
only if it collides with one of the few frequent lines.

Only built-in expressions run. Line hashes are stored once in the shared
folder, as they are counted twice. No text is shuffled for counting: lines are
counted by partial aggregates, so a frequent line costs one row per task. A
host's frequent lines are one array, since no more than 1000 / MIN_THOUSANDTHS
times its mean number of lines can be frequent. These arrays are looked up where
the texts are: Spark broadcasts them while they are small, and joins them in
``SALTS`` shares of each host otherwise.

Nulls: a null text is an empty text, a null source is the host ''; a null
``doc_id`` is kept. Repeated rows give repeated rows and count once. Empty
texts fail the base rules. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm import common
from pitlane.llm.common import WORD
from pitlane.sources import shared

#: A line is frequent from so many documents of a host on, if they are also this share (in thousandths) of the host's.
MIN_DOCUMENTS, MIN_THOUSANDTHS = 10, 10
#: Rejected when more than this share (in hundredths) of the words stood in frequent lines.
MAX_LOST = 50
#: Base rules: least number of words, and most hundredths of them in repeated windows.
MIN_WORDS, MAX_REPEATED = 50, 50
SYMBOLS = "#*$%&|<>"
SALTS = 32

_BLANKS = WORD.replace("^", "")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""

    def covered(places: Column) -> Column:
        step = F.aggregate(
            places,
            F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
            lambda acc, at: F.struct(
                (acc["n"] + F.least(F.lit(3), at - acc["last"])).alias("n"), at.alias("last")
            ),
        )
        return step["n"]

    def of_hashes(hashes: Column) -> Column:
        order = F.sequence(F.lit(0), F.size(hashes) - 1)
        pairs = F.sort_array(F.zip_with(hashes, order, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(pairs: Column, last: Column) -> Column:
            same = F.filter(
                F.sequence(F.lit(0), last),
                lambda k: ((k > 0) & (pairs[k]["h"] == pairs[F.greatest(k - 1, F.lit(0))]["h"]))
                | ((k < last) & (pairs[k]["h"] == pairs[F.least(k + 1, last)]["h"])),
            )
            return F.sort_array(F.transform(same, lambda k: pairs[k]["i"]))

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("bigint")).otherwise(
            covered(_let(pairs, lambda p: twice(p, F.size(p) - 1)))
        )

    windows = _let(
        words,
        lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2])),
    )
    return F.when(F.size(words) < 3, F.lit(0).cast("bigint")).otherwise(_let(windows, of_hashes))


def base_rules(documents: DataFrame) -> DataFrame:
    """``documents`` with the counts of the base rules and ``base_failed`` in place of ``text``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: line.rlike(WORD))
    counted = documents.withColumn("_words", F.array_remove(F.split(text, _BLANKS, -1), "")).withColumns({
        "_lines": lines,
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.array_join("_words", "")).cast("bigint"),
        "n_symbols": F.regexp_count(text, F.lit(f"[{SYMBOLS}]")).cast("bigint"),
    })
    return counted.withColumns({
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint"),
        "n_repeat_words": _repeated_words(F.col("_words")),
    }).withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
    ).drop("_words", "_lines", "text")


def normal_lines(text: Column) -> Column:
    """A text's lines in lower case, with 0 for any number and one space for any white space; one for each line, if empty."""
    plain = F.regexp_replace(F.lower(text), "[0-9]+", "0")
    spaced = F.regexp_replace(plain, "[\\x20\\x09\\x0B-\\x0D]{2,}|[\\x09\\x0B-\\x0D]", " ")
    # Not ``F.trim`` itself, which would take the line's number for the characters to trim.
    return F.transform(F.split(spaced, "\n", -1), lambda line: F.trim(line))


def _hashed_lines(documents: DataFrame) -> DataFrame:
    """``host, line, identity, document``: a line's hash, what the document counts by for it, and for its host."""

    def longest(lines: Column) -> Column:
        return F.array_max(F.transform(lines, lambda x: F.struct(F.length(x).alias("n"), x.alias("line"))))["line"]

    def of_lines(lines: Column) -> Column:
        return _let(F.struct(lines.alias("all"), longest(lines).alias("first")), lambda x: _let(
            F.struct(x["all"].alias("all"), x["first"].alias("first"),
                     longest(F.filter(x["all"], lambda line: line != x["first"])).alias("second")),
            lambda y: F.transform(y["all"], lambda line: F.struct(
                F.xxhash64(line).alias("line"),
                F.xxhash64(F.when(line == y["first"], F.coalesce(y["second"], line)).otherwise(y["first"])).alias("identity"),
                F.xxhash64(y["first"], y["second"]).alias("document"),
            )),
        ))

    found = of_lines(F.array_distinct(F.array_remove(normal_lines(F.col("text")), "")))
    return documents.select("host", F.explode(found).alias("at")).select("host", "at.*")


def frequent_lines(lines: DataFrame) -> DataFrame:
    """``host, frequent``: the hashes of the host's lines above both limits, for hosts that have any."""
    totals = lines.groupBy("host").agg(F.count_distinct("document").alias("of_host"))
    counts = lines.groupBy("host", "line").agg(F.count_distinct("identity").alias("documents"))
    often = counts.filter(F.col("documents") >= MIN_DOCUMENTS).withColumn(
        "salt", F.pmod("line", F.lit(SALTS)).cast("int")
    )
    return often.join(_salted(totals), ["host", "salt"]).filter(
        1000 * F.col("documents") >= MIN_THOUSANDTHS * F.col("of_host")
    ).groupBy("host").agg(F.sort_array(F.collect_list("line")).alias("frequent"))


def _salted(small: DataFrame) -> DataFrame:
    return small.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _judged(documents: DataFrame) -> DataFrame:
    """``documents`` (``host, text, salt`` and any others) with all counts, ``rest`` and ``kept``.

    ``rest`` is the text without its frequent lines, null if it has none.
    """
    lines = shared.store(_hashed_lines(documents), "line_hashes")
    frequent = shared.store(frequent_lines(lines), "frequent_lines")
    looked_up = documents.join(_salted(frequent), ["host", "salt"], "left")

    def without(normal: Column, frequent: Column) -> Column:
        """The words lost, and the lines left of the text."""
        lost = F.transform(normal, lambda x: (x != "") & F.array_contains(frequent, F.xxhash64(x)))
        return _let(lost, lambda gone: F.when(F.array_contains(gone, True), F.struct(
            F.aggregate(
                F.zip_with(normal, gone, lambda x, out: F.when(out, F.size(F.split(x, " "))).otherwise(0)),
                F.lit(0).cast("bigint"), lambda total, n: total + n,
            ).alias("words"),
            F.array_join(
                F.filter(F.split("text", "\n", -1), lambda line, i: ~F.get(gone, i)), "\n"
            ).alias("rest"),
        )))

    cut = F.when(F.col("frequent").isNotNull(), _let(normal_lines(F.col("text")), lambda n: without(n, F.col("frequent"))))
    cut = looked_up.withColumn("cut", cut).select(
        *documents.columns, F.coalesce("cut.words", F.lit(0).cast("bigint")).alias("n_lost_words"), F.col("cut.rest").alias("rest")
    )
    return base_rules(cut).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("n_lost_words") <= MAX_LOST * F.col("n_words"))
    )


def _read(documents: DataFrame, *others: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("source", F.lit("")).alias("host"),
        text.alias("text"), F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int").alias("salt"), *others,
    )


def line_quality(documents: DataFrame) -> DataFrame:
    """One row per document: the base counts, ``n_lost_words``, ``base_failed`` and ``kept``."""
    return _judged(_read(documents)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lost_words", "base_failed",
        "kept",
    )


def kept_documents(documents: DataFrame) -> DataFrame:
    """The documents that all rules keep, with all their columns: frequent lines are taken out of ``text``.

    Where a text lost lines, ``n_chars`` is counted anew, if there is such a column.
    """
    (others,) = common.fresh(documents, "others")
    rest = [c for c in documents.columns if c.lower() != "text"]
    whole = F.struct(*rest, F.lit(0).alias(others)).alias("whole")
    changed = F.col("rest").isNotNull()
    columns = [
        F.when(changed, F.col("rest")).otherwise(F.col("own")).alias(c) if c.lower() == "text"
        else F.when(changed, F.length("rest").cast(documents.schema[c].dataType)).otherwise(F.col(f"whole.`{c}`")).alias(c)
        if c.lower() == "n_chars" else F.col(f"whole.`{c}`")
        for c in documents.columns
    ]
    return _judged(_read(documents, whole, F.col("text").alias("own"))).filter("kept").select(*columns)


SQL = f"""
with d as (
    select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as t from documents
),
w as (
    select rid, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws from d
),
windows as (
    select rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as three
    from (select rid, ws, unnest(range(1, len(ws) - 1)) as i from w)
),
twice as (select rid, i from windows qualify count(*) over (partition by rid, three) > 1),
repeated as (
    select rid, count(distinct i + k) as n_repeat_words from twice, (select unnest([0, 1, 2]) as k) group by rid
),
raw_lines as (select rid, unnest(string_split(t, chr(10))) as line from d),
dups as (
    select rid, count(*) - count(distinct line) as n_dup_lines from raw_lines
    where regexp_matches(line, '[^\\x20\\x09-\\x0D]') group by rid
),
lines as (
    select rid, host, trim(regexp_replace(regexp_replace(lower(line), '[0-9]+', '0', 'g'),
        '[\\x20\\x09-\\x0D]+', ' ', 'g'), ' ') as line
    from raw_lines join d using (rid)
),
longest as (
    select rid, max(case when nth = 1 then line end) as first_line, max(case when nth = 2 then line end) as second_line
    from (select rid, line, row_number() over (partition by rid order by length(line) desc, line desc) as nth
        from (select distinct rid, line from lines where line <> ''))
    group by rid
),
full_lines as (
    select rid, host, line, case when line = first_line then coalesce(second_line, line) else first_line end as identity,
        {{'document': first_line, 'and': second_line}} as document
    from lines join longest using (rid) where line <> ''
),
totals as (select host, count(distinct document) as of_host from full_lines group by host),
frequent as (
    select host, line from full_lines join totals using (host) group by host, line, of_host
    having count(distinct identity) >= {MIN_DOCUMENTS} and 1000 * count(distinct identity) >= {MIN_THOUSANDTHS} * of_host
),
lost as (
    select rid, sum(len(string_split(line, ' '))) as lost from full_lines semi join frequent using (host, line) group by rid
),
counted as (
    select doc_id, len(ws)::bigint as n_words,
        length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::bigint as word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
        coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
        coalesce(lost, 0)::bigint as n_lost_words
    from d join w using (rid) left join repeated using (rid) left join dups using (rid) left join lost using (rid)
)
select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words as base_failed,
    not (n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED} * n_words)
        and 100 * n_lost_words <= {MAX_LOST} * n_words as kept
from counted
"""
