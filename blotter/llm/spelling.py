"""Spelling variants: words one edit apart, found by reduced-alphabet generation.

Every letter is hashed to one of a few symbols, so a word becomes a reduced
word. Words one edit apart have reduced words at most one edit apart, so the
full one-edit neighbourhood of a word's reduced word, joined with the
reduced vocabulary, reaches all its near words; each candidate is then
verified on the original strings. A neighbourhood has about 15 reduced
words a letter, whatever the size of the real alphabet.

A reduced word that many words share (more than ``crowded``) would make
candidates grow with the square of its words. Those are reached another way,
as exact: words whose neighbourhood touches a crowded reduced word generate
their one-edit neighbours over the real letters, keep those that reduce to
a crowded one, and join the vocabulary on the word itself.

Everything is DataFrame expressions; words are counted with a map-side
combine, so a word holding a third of all occurrences is one row per task.
Long texts are cut where a run of letters ends, so no run is split and no
array holds a long text's words at once.

Defined results: a null text has no words; a null id counts as the empty
string before the colon; repeated rows count each; an empty table gives an
empty result; other columns of the input are not read. Ties of equal counts
go to the smallest word in code-point order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import remove, write_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# The letters of lower-cased runs: a-z, and U+00C0 to U+00FF.
LETTERS = LOWER + "".join(map(chr, range(0xC0, 0x100)))
SYMBOLS = "01234567"
CHUNK_CHARS = 65_536
CROWDED = 2_000


def symbol_of(letter: str) -> str:
    """The symbol that a letter is hashed to."""
    return SYMBOLS[ord(letter) % len(SYMBOLS)]


def reduced(word: Column) -> Column:
    """A word with every letter replaced by its symbol."""
    return F.translate(word, LETTERS, "".join(map(symbol_of, LETTERS)))


def runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word) per run of letters of every text, lower-cased, with the damage the contract asks for."""
    cut = f"(?s).{{{CHUNK_CHARS}}}[A-Za-z\\u00C0-\\u00FF]*+|.+"
    pieces = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                         F.explode(F.regexp_extract_all(F.col(text_col), F.lit(cut), F.lit(0))).alias("piece"))
    run = pieces.select("id", F.explode(F.regexp_extract_all(F.translate("piece", UPPER, LOWER), F.lit("[a-z\\u00C0-\\u00FF]+"), F.lit(0))).alias("run"))
    hashed = run.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    at = F.pmod("h", F.length("run")).cast("int")
    return hashed.select(F.when(F.col("h") % 199 == 0, F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run"))))
                          .otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, min_chars: int = 6, min_count: int = 5) -> DataFrame:
    """(word, n) of the distinct words long and frequent enough."""
    return (words.filter(F.length("word") >= min_chars).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
                 .filter(F.col("n") >= min_count))


def neighbourhood(word: Column, letters: str) -> Column:
    """The distinct strings at most one inserted, deleted or replaced letter from ``word``, itself included."""
    each = F.array(*[F.lit(c) for c in letters])
    size = F.length(word)

    def head(i: Column) -> Column:
        return F.substring(word, F.lit(1), i)

    def tail(i: Column) -> Column:
        return F.substring(word, i + 1, size)

    inserted = F.flatten(F.transform(F.sequence(F.lit(0), size), lambda i: F.transform(each, lambda c: F.concat(head(i), c, tail(i)))))
    inner = F.sequence(F.lit(0), size - 1)
    replaced = F.flatten(F.transform(inner, lambda i: F.transform(each, lambda c: F.concat(head(i), c, tail(i + 1)))))
    deleted = F.transform(inner, lambda i: F.concat(head(i), tail(i + 1)))
    return F.array_distinct(F.concat(inserted, replaced, deleted))


def near_words(words: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(word, near, near_n): every ordered pair of words of ``words`` (word, n) exactly one edit apart.

    ``words`` is read several times: pass a written table. The crowded
    reduced words, at most (words / ``crowded``) of them, are broadcast.
    Neighbourhoods never are: Spark sizes them as the words they are made
    of, without the rows that ``explode`` adds, so their joins are hinted.
    """
    keyed = words.select("word", "n", reduced(F.col("word")).alias("key"))
    crowds = F.broadcast(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("_m")).filter(F.col("_m") > crowded).select("key"))
    around = keyed.select("word", F.explode(neighbourhood(F.col("key"), SYMBOLS)).alias("key"))
    sparse = keyed.join(crowds, "key", "left_anti").select("key", F.col("word").alias("near"), F.col("n").alias("near_n"))
    found = around.hint("merge").join(sparse, "key").filter(F.levenshtein("word", "near", 1) == 1).select("word", "near", "near_n")
    touching = around.join(crowds, "key", "left_semi").select("word").distinct()
    spelled = touching.select("word", F.explode(neighbourhood(F.col("word"), LETTERS)).alias("near"))
    spelled = spelled.filter("near <> word").withColumn("key", reduced(F.col("near"))).join(crowds, "key", "left_semi")
    exact = spelled.hint("merge").join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "near", "near_n")
    return found.unionByName(exact)


def forms(words: DataFrame, near: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word: its near word of largest n, if that is ``times`` the word's."""
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best"))
    chosen = F.col("n_near").isNotNull() & (-F.col("best.minus") >= times * F.col("n"))
    return (words.join(best, "word", "left")
                 .select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
                         F.when(chosen, F.col("best.near")).alias("form"), F.when(chosen, -F.col("best.minus")).alias("form_n")))


def with_roots(grouped: DataFrame) -> DataFrame:
    """``grouped`` with ``root``: the end of the chain of forms, or the word itself.

    Counts grow fivefold at each step, so chains are short; pointers are
    doubled until none moves. ``grouped`` must be a written table. The joins
    are hinted: Spark sizes a table by its compressed files, a few times
    smaller than what a broadcast would hold in the driver.
    """
    spark = grouped.sparkSession
    # Only words with a form can be passed through.
    jumps, at = write_table(grouped.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), "spelling-jumps")
    while True:
        onward = jumps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved, moved_at = write_table(jumps.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                                              F.col("further").isNotNull().alias("moved")), "spelling-jumps")
        remove(spark, at)
        jumps, at = moved.select("word", "root"), moved_at
        if moved.filter("moved").isEmpty():
            out, _ = write_table(grouped.join(jumps.hint("merge"), "word", "left").select(*grouped.columns, F.coalesce("root", "word").alias("root")), "spelling-roots")
            remove(spark, at)
            return out


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 6, min_count: int = 5,
                      times: int = 5, crowded: int = CROWDED) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of all texts."""
    words, words_at = write_table(vocabulary(runs(docs, id_col, text_col), min_chars, min_count), "spelling-words")
    grouped, grouped_at = write_table(forms(words, near_words(words, crowded), times), "spelling-forms")
    out = with_roots(grouped).select("word", "form", "root", "n", "n_near", "form_n")
    remove(docs.sparkSession, words_at, grouped_at)
    return out
