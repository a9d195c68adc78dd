"""Line-first cleaning: lines are judged one by one, then what is left of a text.

Built-in column functions only.

A line fails if any rule holds:

* punctuation: it does not end like a sentence, or more than a tenth of its
  characters are ``# * $ % & | < >``;
* navigation: it has three or more separators of menus or paths;
* boilerplate: it carries a licence, copyright, cookie or sign-up phrase, in one of
  four languages.

Failing lines are removed. A text that loses more than ``max_loss`` of the
characters of its words is rejected, as is one that fails the base rules (too
few words, or too many words in repeated windows).
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_RUN, SPACES, let, with_text, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
#: A sentence ends in one of these, before closing quotes or brackets.
ENDING = r"[.!?:;…。！？][\"'”’»)\]]*[\x20\x09-\x0D]*\z"
SEPARATORS = "|»›•·>"
#: Fixed values, by language: English, German, French, Spanish.
BOILERPLATE = (
    "all rights reserved", "licensed under", "licenced under", "released under the",
    "general public license", "copyright (c)", "©", "terms of use", "terms of service",
    "privacy policy", "accept cookies", "use of cookies", "subscribe to our", "sign up for",
    "enable javascript",
    "alle rechte vorbehalten", "nutzungsbedingungen", "datenschutzerklärung", "cookies akzeptieren",
    "newsletter abonnieren",
    "tous droits réservés", "conditions d'utilisation", "politique de confidentialité",
    "accepter les cookies", "abonnez-vous",
    "todos los derechos reservados", "términos de uso", "política de privacidad",
    "aceptar las cookies", "suscríbete",
)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(f"[{chars}]"))


def _word_chars(text: Column) -> Column:
    return F.length(F.array_join(F.split(text, SPACE_RUN), ""))


def _any_of(text: Column, parts: Iterable[str]) -> Column:
    return reduce(Column.__or__, [text.contains(part) for part in parts])


def _wordless(line: Column) -> Column:
    return F.length(F.btrim(line, F.lit(SPACES))) == 0


def _facts(text: Column) -> Column:
    """What a text has at all, so that lines need not be searched for the rest."""
    return F.struct(
        _count(text, SYMBOLS).alias("symbols"),
        _any_of(text, SEPARATORS).alias("separators"),
        let(F.lower(text), lambda small: _any_of(small, BOILERPLATE)).alias("phrases"),
    )


def line_passes(line: Column, facts: Column) -> Column:
    """Whether a line survives the three rules; a line without words does."""
    few_symbols = (facts["symbols"] == 0) | (_count(line, SYMBOLS) * 10 <= F.length(line))
    no_menu = ~facts["separators"] | (_count(line, SEPARATORS) < 3)
    own_words = ~facts["phrases"] | ~let(F.lower(line), lambda small: _any_of(small, BOILERPLATE))
    return _wordless(line) | (line.rlike(ENDING) & few_symbols & no_menu & own_words)


def kept_lines(text: Column) -> Column:
    """The text's lines but the failing ones."""
    return let(
        _facts(text),
        lambda facts: F.filter(_lines(text), lambda line: line_passes(line, facts)),
    )


def _repeat_words(words: Column) -> Column:
    """How many words lie in windows of eight that occur more than once."""

    def covered(hashes: Column) -> Column:
        by_hash = F.array_sort(
            F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        last = F.size(hashes) - 1

        def positions(rows: Column) -> Column:
            twin = F.filter(
                rows,
                lambda r, j: (F.get(rows, j - 1)["h"] == r["h"])
                | ((j < last) & (F.get(rows, j + 1)["h"] == r["h"])),
            )
            return F.array_sort(F.transform(twin, lambda r: r["i"]))

        def union(starts: Column) -> Column:
            n = F.size(starts)
            steps = F.transform(
                starts,
                lambda p, j: F.when(
                    j + 1 < n, F.least(F.lit(WINDOW), F.get(starts, j + 1) - p)
                ).otherwise(WINDOW),
            )
            return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

        return let(let(by_hash, positions), union)

    def of_windows(hashes: Column) -> Column:
        distinct = F.size(F.array_distinct(hashes))
        return F.when(distinct == F.size(hashes), F.lit(0)).otherwise(covered(hashes))

    def of_words(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(own) - (WINDOW - 1))
        windows = F.transform(starts, lambda i: F.xxhash64(F.slice(own, i, WINDOW)))
        return F.when(F.size(own) <= WINDOW, F.lit(0)).otherwise(let(windows, of_windows))

    return let(F.transform(words, lambda w: F.xxhash64(w)), of_words)


def quality(
    text: Column,
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_loss: float = 0.5,
) -> Column:
    """A struct of a text's measures and verdicts.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and
    kept. A null text is an empty one: it has no words, so the base rules fail
    and it is not kept. Windows are told apart by 64-bit hashes within a text.
    """
    text = F.coalesce(text, F.lit(""))

    def left_chars(kept: Column) -> Column:
        some_fail = F.size(kept) < F.size(_lines(text))
        return F.when(some_fail, _word_chars(F.array_join(kept, "\n")))

    def measures(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _count(text, SYMBOLS).cast("long").alias("n_symbols"),
            let(
                F.filter(_lines(text), lambda line: ~_wordless(line)),
                lambda lines: F.size(lines) - F.size(F.array_distinct(lines)),
            )
            .cast("long")
            .alias("n_dup_lines"),
            _repeat_words(words).cast("long").alias("n_repeat_words"),
            let(kept_lines(text), left_chars).alias("left_chars"),
        )

    def verdict(m: Column) -> Column:
        failed = (m["n_words"] < min_words) | (
            100 * m["n_repeat_words"] > max_repeat_percent * m["n_words"]
        )
        left = F.coalesce(m["left_chars"], m["word_chars"])
        enough = left >= m["word_chars"] * (1 - max_loss)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        return F.struct(
            *[m[n].alias(n) for n in names],
            failed.alias("base_failed"),
            (~failed & enough).alias("kept"),
        )

    return let(let(words_of(text), measures), verdict)


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents that pass, without their failing lines.

    All other columns pass through, whatever their names; ``n_chars``, where
    there is one, follows the shorter text.
    """
    kept = docs.where(quality(F.col(text_col))["kept"])
    return with_text(kept, text_col, F.array_join(kept_lines(F.col(text_col)), "\n"))
