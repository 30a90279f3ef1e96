"""Words, filtered words, n-grams and sentences of short texts, by rules and Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry political stance and are never dropped as stop words.
PRESERVE = (
    "not no never none against for with without but however although despite should must need will would "
    "all every both either neither left right us we they them"
).split()
# English stop words.
STOP_WORDS = (
    "a an the and or if then than that this these those of at by from in into on off over under to up down out about as is are was were be been being "
    "am do does did doing have has had having i me my mine you your yours he him his she her hers it its our ours their theirs who whom whose which what when where why how "
    "again further once here there any each few more most other some such only own same so too very can could may might just now also"
).split()


def words(c: Column) -> Column:
    """Words, numbers and marks in order; white space is dropped."""
    return F.regexp_extract_all(c, F.lit(r"(?U)\w+(?:['’]\w+)*|[^\w\s]"), F.lit(0))


def kept(tokens: Column, *, min_length: int = 2, punctuation: bool = False, stop_words: bool = False, preserve: bool = True, lower: bool = True) -> Column:
    """The tokens that stay: marks go, short ones go, preserved words stay, stop words go."""
    def keep(t: Column) -> Column:
        mark = ~t.rlike(r"(?U)^\w")
        low = F.lower(t)
        ok = (F.lit(punctuation) | ~mark) & (F.length(t) >= min_length)
        stops = low.isin(*STOP_WORDS) if not stop_words else F.lit(False)
        return ok & ((low.isin(*PRESERVE) if preserve else F.lit(False)) | ~stops)

    out = F.filter(tokens, keep)
    return F.transform(out, F.lower) if lower else out


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` tokens, joined by a space; none if there are fewer."""
    return F.when(F.size(tokens) >= n, F.transform(F.sequence(F.lit(1), F.size(tokens) - n + 1), lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def sentence_parts(c: Column) -> Column:
    """Parts at white space after ``.``, ``!`` or ``?``; empty parts are dropped."""
    return F.filter(F.split(c, r"(?<=[.!?])\s+"), lambda s: F.trim(s) != "")


def tokenized(c: Column) -> Column:
    """Struct of tokens, filtered tokens, sentences and their counts."""
    t = words(c)
    f, s = kept(t), sentence_parts(c)
    return F.struct(t.alias("tokens"), f.alias("filtered"), s.alias("sentences"), F.size(t).alias("token_count"), F.size(f).alias("filtered_count"), F.size(s).alias("sentence_count"))
