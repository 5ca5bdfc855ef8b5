"""Quality rules: a threshold table compiled into one projection of text ratios.

Only Spark SQL functions; one pass, no shuffle. Per text: its words (runs of
other than ASCII blanks), lines and characters are counted, the ratios of the
rule table are formed from the counts, and every rule becomes one Boolean.

Defined cases: a null or empty text has no words, so it fails the length rule.
Every row is judged on its own: repeated rows get equal verdicts, null ids and
languages are kept as they are, an empty table gives an empty table. Columns of
the input that share a name with a result column are replaced by the result.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import BLANK_CHARS, clear_of

WINDOW = 5


class Rule(NamedTuple):
    """A text passes if ``low * whole <= 100 * part <= high * whole``, or ``low <= part <= high`` without a whole.

    Ratios are compared as products of whole numbers, so no rounding decides.
    """

    name: str
    part: str
    whole: str | None
    low: float | None
    high: float | None


#: The contract's base rules.
BASE = (
    Rule("few_words", "n_words", None, 10, None),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 20),
)

#: The method's own rules: length, symbols, stop words, lines. ``n_stop_words`` counts
#: different lower-case stop words; ``n_unstopped`` is the length of a text with fewer
#: than two, so that only longer texts (over 50 words) are asked to hold some.
RULES = (
    Rule("long_words", "word_chars", "n_words", None, 2500),
    Rule("symbols", "n_symbols", "n_words", None, 30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
    Rule("stop_words", "n_unstopped", None, None, 50),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30),
)

#: Frequent words of English, German, French and Spanish.
STOP_WORDS = (
    "the of and to in is that for it as was with be by on not he his but at are this have from or an they which "
    "der die und das nicht von sie ist des sich mit dem dass er es ein ich auf so eine auch als an nach wie im für "
    "le la les et de des un une du que est pour qui dans a par plus pas au sur ne se ce il sont "
    "el los las y en del que se por con para una su al lo como más o pero sus"
).split()


def passes(rule: Rule) -> Column:
    part, whole = F.col(rule.part), F.col(rule.whole) if rule.whole else None
    scaled = part if whole is None else 100 * part
    bounds = []
    if rule.low is not None:
        bounds.append(scaled >= (F.lit(rule.low) if whole is None else rule.low * whole))
    if rule.high is not None:
        bounds.append(scaled <= (F.lit(rule.high) if whole is None else rule.high * whole))
    return reduce(lambda a, b: a & b, bounds)


def compiled(rules: tuple[Rule, ...]) -> Column:
    """One Boolean over all rules of a table."""
    return reduce(lambda a, b: a & b, map(passes, rules))


def repeat_words() -> Column:
    """Words that lie in a window of five words found twice or more in ``_words``.

    ``_windows`` holds a 64-bit hash per window start. A text whose windows are
    all distinct, seen from the size of their set, is done; else equal hashes are
    brought together by a sort of (hash, start) and each repeated start covers
    five words, or as many as there are up to the next repeated start.
    """
    starts = """
      transform(
        filter(
          transform(_sorted, (x, k) -> if(
            (k > 0 AND x.h = element_at(_sorted, k).h)
              OR (k + 1 < size(_sorted) AND x.h = element_at(_sorted, k + 2).h), x.i, -1)),
          i -> i >= 0),
        i -> i)"""
    pairs = "transform(_windows, (h, i) -> struct(h, i))"
    covered = f"""
      aggregate(
        array_sort_bound,
        named_struct('n', 0L, 'end', 0),
        (acc, i) -> named_struct('n', acc.n + (i + {WINDOW} - greatest(acc.end, i)), 'end', i + {WINDOW}),
        acc -> acc.n)"""
    # Bind the two arrays once each: a one-element array acts as a let.
    bound = f"""
      element_at(transform(array(sort_array({pairs})), _sorted ->
        element_at(transform(array(sort_array({starts})), array_sort_bound -> {covered}), 1)), 1)"""
    return F.expr(f"if(size(array_distinct(_windows)) = size(_windows), 0L, {bound})")


def text_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules refer to."""
    names = (
        "n_words word_chars n_symbols n_lines n_dup_lines n_repeat_words n_stop_words n_unstopped "
        "n_ellipsis_lines _counts _text _words _windows _lines"
    ).split()
    stop = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))
    held = F.coalesce(F.col(text), F.lit(""))
    rest = [c for c in docs.columns if c.lower() not in names]
    split = docs.select(
        *rest,
        held.alias("_text"),
        F.expr(
            f"if(trim(BOTH {BLANK_CHARS} FROM coalesce(`{text}`, '')) = '', cast(array() AS array<string>), "
            f"split(trim(BOTH {BLANK_CHARS} FROM `{text}`), '[{BLANK_SQL}]+'))"
        ).alias("_words"),
        F.expr(rf"filter(split(coalesce(`{text}`, ''), '\n'), l -> trim(BOTH {BLANK_CHARS} FROM l) != '')").alias(
            "_lines"
        ),
    )
    windows = split.withColumn(
        "_windows",
        F.expr(
            f"if(size(_words) < {WINDOW}, cast(array() AS array<bigint>), "
            f"transform(sequence(0, size(_words) - {WINDOW}), "
            f"i -> xxhash64({', '.join(f'get(_words, i + {k})' for k in range(WINDOW))})))"
        ),
    )

    def n(expression: str) -> Column:
        return F.expr(expression).cast("long")

    counts = F.struct(
        n("size(_words)").alias("n_words"),
        n("char_length(array_join(_words, ''))").alias("word_chars"),
        n("char_length(regexp_replace(_text, '[^#*$%&|<>]+', ''))").alias("n_symbols"),
        n("size(_lines)").alias("n_lines"),
        n("size(_lines) - size(array_distinct(_lines))").alias("n_dup_lines"),
        repeat_words().alias("n_repeat_words"),
        n("size(filter(_lines, l -> l LIKE '%...' OR l LIKE '%…'))").alias("n_ellipsis_lines"),
        n(f"size(array_intersect(_words, array({stop})))").alias("n_stop_words"),
    )
    # A filter on a verdict would be moved down to the texts, with a copy of the whole
    # expression at each place it names a count; a generated row keeps it above.
    counted = windows.select(*rest, F.explode(F.array(counts)).alias("_counts")).select(*rest, "_counts.*")
    unstopped = F.when(F.col("n_stop_words") < 2, F.col("n_words")).otherwise(F.lit(0)).cast("long")
    return counted.withColumn("n_unstopped", unstopped)


BLANK_SQL = r"\\x20\\x09-\\x0D"


def judge(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with their counts, a Boolean per rule (true: passed), ``base_failed`` and ``kept``."""
    plain = clear_of(docs, "base_failed", "kept", *[f"ok_{r.name}" for r in (*BASE, *rules)])
    counted = text_counts(plain, text)
    return counted.select(
        "*",
        *[passes(r).alias(f"ok_{r.name}") for r in rules],
        (~compiled(BASE)).alias("base_failed"),
        (compiled(BASE) & compiled(rules)).alias("kept"),
    )
