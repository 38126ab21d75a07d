"""Quality rules by distribution divergence.

The histogram of character classes and the histogram of common words of a document are
compared with those of its language, by Jensen-Shannon distance. The language references
are means over all documents of the corpus that name the language. A document of no known
language is compared with every language, one of a rare language with its own, too.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import append, apart, free_name, map_batches, whole_text
from mediamix.session import cut_lineage

#: Frequent function words of four languages.
COMMON_WORDS = (
    "the of and a to in is that it was for on are as with be at by this from or an not he have "
    "le la les de du des et un une en que qui dans pour par sur est au avec ne pas ce il se plus "
    "der die das und ein eine zu von mit den dem des ist auf im nicht sich es für als auch "
    "el los las y un una en que por con para del al es se no su lo como"
).split()
#: What base_failed and its counts are defined by.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
LEAST_WORDS = 50
#: Character classes of UTF-8 bytes; continuation bytes belong to no character of their own.
CLASSES = ("lower", "upper", "digit", "space", "stop", "exclaim", "symbol", "other", "beyond_ascii")

WORD_INDEX = {w.encode(): i for i, w in enumerate(dict.fromkeys(COMMON_WORDS))}
N_WORDS, N_CLASSES = len(WORD_INDEX) + 1, len(CLASSES)


def _classes() -> np.ndarray:
    """256 x classes, 1 where a byte starts a character of the class."""
    of = np.full(256, CLASSES.index("other"))
    for name, members in (
        ("lower", range(97, 123)),
        ("upper", range(65, 91)),
        ("digit", range(48, 58)),
        ("space", SPACE),
        ("stop", b".,;:?'\"()-"),
        ("exclaim", b"!"),
        ("symbol", SYMBOLS),
        ("beyond_ascii", range(192, 256)),
    ):
        of[list(members)] = CLASSES.index(name)
    table = np.eye(N_CLASSES)[of]
    table[128:192] = 0
    return table


CLASS_OF = _classes()


class Measured:
    """Counts of one text."""

    def __init__(self, text: str):
        data = text.encode()
        self.data, self.words = data, data.split()  # bytes.split() splits at the ASCII white space
        self.bytes = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        self.chars = self.bytes @ CLASS_OF
        self.codes: dict[bytes, int] = {}
        place = self.codes.setdefault
        self.sequence = np.array([place(w, len(self.codes)) for w in self.words], np.int64)

    def common(self) -> np.ndarray:
        """Counts of the common words, and of all others."""
        out = np.zeros(N_WORDS)
        if self.words:
            times = np.bincount(self.sequence)
            index = WORD_INDEX.get
            found = [(i, n) for w, n in self.codes.items() if (i := index(w.strip(b".,;:").lower())) is not None]
            for i, n in found:
                out[i] += times[n]
            out[-1] = len(self.words) - out.sum()
        return out

    def repeated(self) -> int:
        """Words in windows of three that are found twice or more."""
        s, n = self.sequence, len(self.sequence) - 2
        if n < 2:
            return 0
        size = np.int64(len(self.codes))
        pairs = s[:-1] * size + s[1:]
        if size > 2_000_000:
            pairs = np.unique(pairs, return_inverse=True)[1].reshape(-1).astype(np.int64)
        keys = pairs[:-1] * size + s[2:]
        order = np.argsort(keys, kind="stable")
        same = keys[order][1:] == keys[order][:-1]
        if not same.any():
            return 0
        often = np.zeros(n, bool)
        often[order[1:][same]] = often[order[:-1][same]] = True
        covered = np.zeros(n + 2, bool)
        for shift in range(3):
            covered[shift : n + shift] |= often
        return int(covered.sum())

    def base(self) -> tuple[int, int, int, int, int]:
        """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
        n_chars = int(self.bytes.sum() - self.bytes[128:192].sum())
        lines = [x for x in self.data.split(b"\n") if x.strip()]
        space, symbols = (int(self.bytes[list(s)].sum()) for s in (SPACE, SYMBOLS))
        return len(self.words), n_chars - space, symbols, len(lines) - len(set(lines)), self.repeated()


def distance(counts: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance (base 2) of the shares of ``counts`` and ``reference``, or each row of it."""
    p, q = counts / counts.sum(), reference / reference.sum(-1, keepdims=True)
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0).sum(-1) for x in (p, q)]
    return np.sqrt(np.maximum(0.0, sum(parts) / 2))


def references(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Mean shares of classes and common words: (lang, n_docs, shares), also for lang null.

    A mean over all documents of at least ``LEAST_WORDS`` words, long ones weighing as
    short ones. Tasks sum up what they read; what is shuffled has a row per task batch and
    language. The row of null is over all documents, whatever their language.
    """

    def make():
        def run(columns: dict) -> dict:
            sums: dict = {}
            for t, language in zip(columns["text"], columns["lang"]):
                measured = Measured(t)
                if len(measured.words) >= LEAST_WORDS:
                    shares = np.concatenate([measured.chars / measured.chars.sum(), measured.common() / len(measured.words)])
                    for key in {language, None}:
                        n, total = sums.get(key, (0, 0.0))
                        sums[key] = (n + 1, total + shares)
            return {"lang": list(sums), "n": [n for n, _ in sums.values()], "sums": [s.tolist() for _, s in sums.values()]}

        return run

    part = map_batches(docs.select(whole_text(text).alias("text"), F.col(lang).alias("lang")), make, "lang string, n bigint, sums array<double>")
    sums = part.select("lang", "n", F.posexplode("sums").alias("at", "part")).groupBy("lang", "at").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
    cell = F.struct("at", (F.col("total") / F.col("n")).alias("mean"))
    means = sums.groupBy("lang").agg(F.max("n").alias("n_docs"), F.sort_array(F.collect_list(cell)).alias("cells"))
    return means.select("lang", "n_docs", F.col("cells.mean").alias("shares"))


FIELDS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "base_failed boolean, char_distance double, word_distance double, kept boolean"
)
#: Distances beyond which a document is rejected. The histogram of n words strays from
#: its language's by chance as 1 / sqrt(n), so each bound is a + b / sqrt(n).
MOST_CHAR, MOST_WORD = (0.15, 1.0), (0.14, 1.75)
#: Documents that a language needs for a reference under these bounds; that of fewer, n,
#: strays and may be half of junk, so its bounds are wider by RARE / sqrt(n).
LEAST_DOCS, RARE = 20, 0.5


def judge(docs: DataFrame, text: str = "text", lang: str = "lang", keep: list[str] | None = None, name: str = "quality", most_char: tuple[float, float] = MOST_CHAR, most_word: tuple[float, float] = MOST_WORD) -> DataFrame:
    """``keep`` columns of ``docs`` (all, if None) and the struct ``name``.

    Fields: the base counts ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``; ``base_failed`` (under 50 words, or more than half of the words in
    repeated windows of three); ``char_distance`` and ``word_distance`` from the language's
    reference, or from its blend with the reference over all documents where that is nearer
    (as for texts that quote another language); ``kept``: not ``base_failed``, and both distances within their bounds.
    Documents under the minimum length have no distances (null) and are never kept. A null
    text has no words. Every row is judged alone, repeated rows alike; other columns pass
    through. An empty table gives an empty result.

    A document of a language with under ``LEAST_DOCS`` long documents is kept within wider
    bounds of its language's mean, or within the usual bounds of any other language. One of
    a null language is kept within the bounds of any language; its distances shown are from
    the reference over all, by which nothing is rejected, as no language is near a mixture.
    Where no language has a reference, only ``base_failed`` decides on a null language.
    References of the languages with enough documents, a row each, go to all tasks.
    """
    found = cut_lineage(references(docs, text, lang))
    own = apart(docs, found.where("lang IS NOT NULL").select("lang", "shares", "n_docs"))
    row = found.where("lang IS NULL").select("shares").collect()  # one row of fixed width
    every = np.array(row[0][0]) if row else None  # none: no document is long enough to be compared
    known = np.array([r.shares for r in found.where(f"lang IS NOT NULL AND n_docs >= {LEAST_DOCS}").orderBy("lang").select("shares").collect()])
    keep = docs.columns if keep is None else keep
    joined = docs.join(own, F.col(lang) == F.col(own.columns[0]), "left")

    def make():
        def nearest(counts: np.ndarray, own: np.ndarray, every: np.ndarray) -> np.ndarray:
            return np.minimum(distance(counts, own), distance(counts, own + every))

        def run(texts: list[str], shares: list[list[float]], sizes: list[int]) -> list[tuple]:
            rows = []
            for t, reference, size in zip(texts, shares, sizes):
                measured = Measured(t)
                base = measured.base()
                failed = base[0] < LEAST_WORDS or 100 * base[4] > 50 * base[0]
                chars = words = None
                kept = not failed
                if base[0] >= LEAST_WORDS:
                    counts = measured.chars, measured.common()
                    bounds = [a + b / np.sqrt(base[0]) for a, b in (most_char, most_word)]

                    def distances(own: np.ndarray) -> list[np.ndarray]:
                        parts = slice(N_CLASSES), slice(N_CLASSES, None)
                        return [nearest(c, own[..., p], every[p]) for c, p in zip(counts, parts)]

                    chars, words = map(float, distances(every if reference is None else np.array(reference)))
                    rare = reference is not None and size < LEAST_DOCS
                    more = RARE / np.sqrt(size) if rare else 0
                    within = chars <= bounds[0] + more and words <= bounds[1] + more
                    if reference is None or rare and not within:
                        within = not rare and not len(known)
                        if len(known):
                            each = distances(known)
                            within = ((each[0] <= bounds[0]) & (each[1] <= bounds[1])).any()
                    kept = kept and within
                rows.append((*base, bool(failed), chars, words, bool(kept)))
            return rows

        return run

    return append(joined, make, [whole_text(text), F.col(own.columns[1]), F.col(own.columns[2])], FIELDS, name, keep)


def accepted(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """The documents that ``judge`` keeps, columns as they were."""
    name = free_name(docs, "quality")
    return judge(docs, text, lang, None, name).where(f"{name}.kept").select(*docs.columns)
