"""Secret scan: known forms, and a randomness test battery for unknown ones.

Known forms are found by pattern. Beside them, every long run of encoding
characters that mixes letters and digits is a candidate. Its encoding is
inferred (hex, base32, base36, base62, base64), and six tests compare it with a
uniform draw from that alphabet: chi-squared over classes of symbols and over
case and digits, the number of runs about the middle of the alphabet, the serial
correlation of neighbours, changes between vowels and consonants, and changes
between case and digits. Their p-values are combined by Fisher's method: the smaller the
statistic, the better uniform chance explains the run.

What is not random is given by a fixed model of word-like runs (``word_like``):
pronounceable words and short numbers, written as the encoding's alphabet
allows. The logarithm of their statistic has a normal lower tail; its place and
width are fixed values, by alphabet and length class. A candidate's p-value is
the chance that such a run looks at least as random, however small that is; one
that the battery itself rejects as a uniform draw is out. So a key's verdict does
not ask what else stands in the corpus, but for the false-discovery rate
(Benjamini and Hochberg), which is held within each length class of an encoding.
All counts behind it are a histogram of a fixed number of cells.
"""

from __future__ import annotations

import math
import random
import re
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.A | re.I,
)
# A maximal run that is too short holds no longer match, so the length can be asked for here.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
RUN = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")

HEX_LOW, HEX_UP = "0123456789abcdef", "0123456789ABCDEF"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
BASE36_LOW, BASE36_UP = "abcdefghijklmnopqrstuvwxyz0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
ALPHABETS = (
    HEX_LOW, HEX_UP, BASE32, BASE36_LOW, BASE36_UP, BASE62, BASE62 + "+/", BASE62 + "-_",
    BASE62 + "+/-_",
)
VOWELS = frozenset("aeiouyAEIOUY")
#: Lower ends of the length classes.
LENGTHS = (20, 24, 32, 48, 64)
#: What one uniform draw in a thousand exceeds (chi-squared, 12 degrees of freedom). A run
#: that the battery rejects like that is not random, however little it looks like words.
REJECTED = 32.91
#: Of log(1 + statistic) of word-like runs as long as the shortest of each length
#: class, the median, and its distance from the first hundredth by that of a normal distribution.
WORD_LIKE = {
    16: ((3.774, 0.320), (3.894, 0.312), (4.128, 0.280), (4.540, 0.270), (4.782, 0.237)),
    32: ((3.470, 0.210), (3.597, 0.205), (3.838, 0.192), (4.149, 0.171), (4.382, 0.158)),
    36: ((3.667, 0.232), (3.814, 0.228), (4.056, 0.216), (4.396, 0.194), (4.640, 0.174)),
    62: ((4.115, 0.325), (4.265, 0.322), (4.500, 0.311), (4.924, 0.306), (5.192, 0.292)),
    64: ((3.921, 0.313), (4.054, 0.299), (4.285, 0.284), (4.674, 0.281), (4.927, 0.265)),
    66: ((3.942, 0.307), (4.076, 0.302), (4.313, 0.296), (4.702, 0.285), (4.953, 0.273)),
}
#: Cells of the statistic, half a unit wide; the last one is open.
CELLS = 200


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the known forms, leftmost and non-overlapping in each kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _normal_tails(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2))


def _chi_tail(x: float, freedom: int) -> float:
    """P(chi-squared > x), by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    m = 2 / (9 * freedom)
    return 0.5 * math.erfc(((x / freedom) ** (1 / 3) - (1 - m)) / math.sqrt(2 * m))


def _changes_tail(kinds: list, shares, above: bool) -> float:
    """P(as many changes between neighbours' kinds, or as few) for independent draws; None parts."""
    pairs = [(a, b) for a, b in zip(kinds, kinds[1:], strict=False) if a is not None and b is not None]
    both = sum(None not in t for t in zip(kinds, kinds[1:], kinds[2:], strict=False))
    q = 1 - sum(x * x for x in shares)
    var = len(pairs) * q * (1 - q) + 2 * both * (sum(x * (1 - x) ** 2 for x in shares) - q * q)
    if not pairs or var <= 0:
        return 1.0
    z = (sum(a != b for a, b in pairs) - len(pairs) * q) / math.sqrt(var)
    return 0.5 * math.erfc((z if above else -z) / math.sqrt(2))


def alphabet_of(run: str) -> str:
    own = set(run.rstrip("="))
    return next(a for a in ALPHABETS if own <= set(a))


def statistic(run: str, alphabet: str | None = None) -> float:
    """Fisher's combination of the battery's p-values; small for uniform draws."""
    alphabet = alphabet or alphabet_of(run)
    order = {c: i for i, c in enumerate(alphabet)}
    values = np.array([order[c] for c in run.rstrip("=")], dtype=float)
    n, size = len(values), len(alphabet)
    # Classes of symbols, fine enough to differ and coarse enough to be expected often.
    classes = max(2, min(8, n // 5))
    counts = np.bincount((values * classes // size).astype(int), minlength=classes)
    edges = [math.ceil(k * size / classes) for k in range(classes + 1)]
    expected = n * np.diff(edges) / size
    uniform = _chi_tail(float(((counts - expected) ** 2 / expected).sum()), classes - 1)
    # Letters' case and digits are what encodings mix and words do not.
    kinds = [sum(c.isdigit() for c in alphabet), sum(c.islower() for c in alphabet),
             sum(c.isupper() for c in alphabet)]
    own = [sum(c.isdigit() for c in run), sum(c.islower() for c in run),
           sum(c.isupper() for c in run)]
    pairs = [(o, n * k / size) for o, k in zip(own, kinds, strict=True) if k]
    mixed = (
        _chi_tail(sum((o - e) ** 2 / e for o, e in pairs), len(pairs) - 1) if len(pairs) > 1 else 1.0
    )
    above = values >= size / 2
    up, down = int(above.sum()), int(n - above.sum())
    if up and down:
        mean = 2 * up * down / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        runs = _normal_tails((1 + int((above[1:] != above[:-1]).sum()) - mean) / math.sqrt(var))
    else:
        runs = 0.5 ** (n - 1)
    spread = values - values.mean()
    whole = float((spread**2).sum())
    serial = (
        _normal_tails(float((spread[1:] * spread[:-1]).sum()) / whole * math.sqrt(n)) if whole else 0.0
    )
    # Words alternate vowels and consonants and seldom change between case and digits.
    sounds = [c in VOWELS if c.isalpha() else None for c in run]
    signs = [c for c in alphabet if c.isalpha()]
    v = sum(c in VOWELS for c in signs) / len(signs)
    sound = _changes_tail(sounds, (v, 1 - v), True)
    shares = [*(k / size for k in kinds), 1 - sum(kinds) / size]
    change = _changes_tail([c.isdigit() + 2 * c.islower() + 3 * c.isupper() for c in run], shares, False)
    tests = (uniform, mixed, runs, serial, sound, change)
    return sum(-2 * math.log(min(max(p, 1e-30), 1.0)) for p in tests)


def _cell(value: float) -> int:
    return min(int(2 * value), CELLS - 1)


def _length_class(n: int) -> int:
    return sum(n >= low for low in LENGTHS) - 1


def random_candidates(text: str, base: list[tuple[int, int, int]]):
    """Candidates (start, end, class, cell) outside the base spans.

    A class is one of length and alphabet.
    """
    candidates = []
    for m in RUN.finditer(text):
        run = m[0]
        if any(c.isdigit() for c in run) and any(c.isalpha() for c in run):
            if all(m.end() <= s or e <= m.start() for s, _, e in base):
                cls = _length_class(len(run)) * len(ALPHABETS) + ALPHABETS.index(alphabet_of(run))
                candidates.append((m.start(), m.end(), cls, _cell(statistic(run))))
    return candidates


def word_like(rng: random.Random, alphabet: str, n: int) -> str:
    """``n`` characters of words and numbers as the alphabet allows, with a letter and a digit.

    Words have one to four syllables of a vowel between consonants, by their
    shares in English; hex ones are drawn from its letters. One word in three is
    followed by a number of up to four digits, small first digits being likelier,
    or (hex) padded with zeros. Where there are both cases, half the runs are
    lower case and half have capitals at their words; signs stand between words.
    """
    own = set(alphabet)
    hexed, signs = len(alphabet) == 16, [c for c in alphabet if not c.isalnum()]
    digits = [c for c in "123456789" if c in own]
    capital = rng.random() < 0.5
    while True:
        parts: list[str] = []
        size = 0
        sign = rng.choice(signs) if signs else ""
        while size < n:
            if hexed:
                word = "".join(rng.choice("bcdf") + rng.choice("ae") for _ in range(rng.randint(1, 2)))
            else:
                word = "".join(
                    rng.choices(_ONSETS, _ONSET_SHARES)[0]
                    + rng.choices("eaoiuy", (127, 82, 75, 70, 28, 20))[0]
                    + (rng.choice("nrstldm") if rng.random() < 0.4 else "")
                    for _ in range(rng.randint(1, 4))
                )
            if "a" not in own:
                word = word.upper()
            elif "A" in own and capital:
                word = word.capitalize()
            number = ""
            if rng.random() < (0.8 if hexed else 1 / 3):
                number = rng.choices(digits, [1 / k for k in range(1, len(digits) + 1)])[0]
                number += "".join(rng.choice([*digits, *"0"] if "0" in own else digits)
                                  for _ in range(rng.randint(0, 3)))
                number = number.rjust(rng.choice((1, 4, 8)), "0") if hexed else number
            parts.append(word + number)
            size += len(parts[-1]) + len(sign)
        start = rng.randrange(size - n + 1) if size > n else 0
        run = sign.join([*parts, ""])[start : start + n]
        if any(c.isdigit() for c in run) and any(c.isalpha() for c in run):
            return run


_ONSETS = "tnshrdlcmwfgpbvkjxqz"
_ONSET_SHARES = (91, 67, 63, 61, 60, 43, 40, 28, 24, 24, 22, 20, 19, 15, 10, 8, 2, 2, 1, 1)


def p_value(cls: int, cell: int) -> float:
    """The chance that a class's word-like run falls into the cell or one below it."""
    length, alphabet = divmod(cls, len(ALPHABETS))
    middle, width = WORD_LIKE[len(ALPHABETS[alphabet])][length]
    return 0.5 * math.erfc((middle - math.log1p((cell + 1) / 2)) / width / math.sqrt(2))


def accepted_cells(candidates: dict[tuple[int, int], int], rate: float) -> list[int]:
    """For each class, the first cell that is no longer accepted."""
    out = []
    for cls in range(len(LENGTHS) * len(ALPHABETS)):
        seen = list(accumulate(candidates.get((cls, c), 0) for c in range(CELLS)))
        tried = range(int(2 * REJECTED))
        good = [c + 1 for c in tried if seen[c] and p_value(cls, c) * seen[-1] <= rate * seen[c]]
        out.append(max(good, default=0))
    return out


def scan(
    docs: DataFrame, rate: float = 0.01, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, kind, end), in that order.

    ``base`` has the known forms only. Kinds are places in ``KINDS``; positions
    count code points, ends are exclusive. A null or
    empty text has no spans; without rows there is no result. Rows are taken one
    by one: repeated rows give repeated results, a null id stays null.
    """

    def find(batches):
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                base = base_spans(text) if text else []
                more = random_candidates(text, base) if text else []
                out.append(
                    (
                        doc, [s for s, _, _ in base], [k for _, k, _ in base],
                        [e for _, _, e in base], [c[0] for c in more], [c[1] for c in more],
                        [c[2] * CELLS + c[3] for c in more],
                    )
                )
            made = pd.DataFrame(out, columns=names)
            yield made.assign(doc_id=made["doc_id"].astype("Int64"))

    names = ["doc_id", "start", "kind", "end", "more_start", "more_end", "more_at"]
    kinds = ["long"] + ["array<int>"] * 6
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).mapInPandas(find, ", ".join(map(" ".join, zip(names, kinds, strict=True))))
    rows = stage(rows, "spans")

    cells = rows.select(F.explode("more_at").alias("at")).groupBy("at").count().collect()
    limits = accepted_cells({divmod(r["at"], CELLS): r["count"] for r in cells}, rate)
    limit_of = F.array(*map(F.lit, limits))
    base = F.arrays_zip("start", "kind", "end")
    more = F.transform(
        F.filter(
            F.arrays_zip("more_start", "more_end", "more_at"),
            lambda m: F.pmod(m["more_at"], F.lit(CELLS))
            < F.get(limit_of, F.floor(m["more_at"] / CELLS).cast("int")),
        ),
        lambda m: F.struct(
            m["more_start"].alias("start"),
            F.lit(KINDS.index("random")).alias("kind"),
            m["more_end"].alias("end"),
        ),
    )
    return rows.select(
        "doc_id", base.alias("base"), F.array_sort(F.concat(base, more)).alias("spans")
    )


def span_text(spans, kinds=KINDS):
    """kind:start:end of an array of spans, joined by commas."""
    name = lambda k: F.element_at(F.array(*map(F.lit, kinds)), k + 1)
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"], s["end"])), ","
    )
