"""Line dedup by winnowing over line hashes.

Every line with a word has a hash. A window is the shortest run of such lines of at least
``least_words`` words that starts, or that ends, at a line; the line of the least hash in
each window is selected. What is selected depends on the content of the window only, so
two places that share a run of at least ``least_words`` words select the same line in it:
these fingerprints are guaranteed, and a run whose fingerprints occur once in the corpus
occurs once.

Positions of fingerprints that occur more often are joined to the earliest place of their
window. From such a match the run is extended both ways, line by line: the next window
overlaps in all lines but those added, and is looked up in the same join. So an extension
never fetches the other document, and may go on at any earlier place: no part of a
repeated run is lost because its fingerprint first occurs elsewhere, in other company.
Every line of every repeated run of ``least_words`` words is in such a window (one that
starts at it, or else one that ends at the end of the run), so what is deleted is exactly
the later repeated runs.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediamix.llm.common import append, apart, free_name, map_batches, row_key, same_row, type_of, whole_text
from mediamix.session import cut_lineage, release

LEAST_WORDS = 50


def windows(words: list[int], least: int) -> list[tuple[int, int]]:
    """(first, last) lines of the shortest runs of ``least`` words from and up to each line."""
    ends = np.cumsum(words, dtype=np.int64)
    starts = ends - np.asarray(words, dtype=np.int64)
    last = np.searchsorted(ends, starts + least).tolist()
    first = (np.searchsorted(starts, ends - least, side="right") - 1).tolist()
    return sorted({*((a, b) for a, b in enumerate(last) if b < len(words)), *((a, b) for b, a in enumerate(first) if a >= 0)})


def fingerprints(text: str, least: int) -> tuple[int, list[dict]]:
    """Number of lines with a word, and its windows: selected hash, content, place."""
    lines = [x for x in text.encode().split(b"\n") if x.strip()]
    digests = [xxhash.xxh3_128_digest(x.strip()) for x in lines]
    hashes = np.frombuffer(b"".join(d[:8] for d in digests), np.int64)
    made = []
    for a, b in windows([len(x.split()) for x in lines], least) if lines else ():
        selected = int(hashes[a]) if a == b else int(hashes[a : b + 1].min())
        made.append({"selected": selected, "content": xxhash.xxh3_128_digest(b"".join(digests[a : b + 1])), "first": a, "last": b})
    return len(lines), made


def runs(matched: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of lines: each match extended both ways through those that overlap it."""
    out: list[list[int]] = []
    for first, last in sorted(matched):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out]


def without(text: str, gone: list[tuple[int, int]]) -> str:
    """The text without the lines of these runs, and the blank lines that follow one of them."""
    kept, at, inside = [], -1, False
    places = {n for a, b in gone for n in range(a, b + 1)}
    for line in text.split("\n"):
        if line.encode().strip():
            at += 1
            inside = at in places
        if not inside:
            kept.append(line)
    return "\n".join(kept)


WINDOW = "struct<selected:bigint,content:binary,first:int,last:int>"


def repeated_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(id, text_hash, matched) of the documents with runs that occur earlier; see the module.

    A place is earlier by id (null last), hash of the text, then line.
    """

    def make():
        def run(columns: dict) -> dict:
            found = [fingerprints(t, least_words) for t in columns["text"]]
            return {"id": columns["id"], "text_hash": columns["text_hash"], "windows": [w for _, w in found]}

        return run

    plain = docs.select(row_key(key, text).alias("row"), whole_text(text).alias("text")).select("row.*", "text")
    ddl = f"id {type_of(docs, key)}, text_hash bigint, windows array<{WINDOW}>"
    described = cut_lineage(map_batches(plain, make, ddl).where("size(windows) > 0"))
    placed = described.select("id", "text_hash", F.inline("windows"))
    # winnowing: a window can only occur again if the line selected in it does
    often = placed.groupBy("selected").agg(F.count("*").alias("n")).where("n > 1")
    positions = placed.join(often, "selected", "left_semi").drop("selected")
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "first")
    earliest = positions.groupBy("content").agg(F.min(place).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    later = positions.join(earliest.select("content", "earliest"), "content").where(place > F.col("earliest"))
    found = cut_lineage(later.groupBy("id", "text_hash").agg(F.collect_set(F.struct("first", "last")).alias("matched")))
    release(described)
    return found


FIELDS = "n_lines bigint, n_deleted bigint, runs string, text string"


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = LEAST_WORDS, keep: list[str] | None = None, name: str = "dedup") -> DataFrame:
    """Delete every run of lines of ``least_words`` words or more that occurs earlier.

    Returns ``keep`` columns (all, if None) and struct ``name``: ``n_lines`` (with a word),
    ``n_deleted``, ``runs`` (``first:last`` of the deleted runs, counted in lines with a
    word, comma-joined) and ``text`` (the input where nothing was deleted). Earlier is in
    order of id, then text hash, then line, within the document too, so of each repeated
    run the first stays, and every deleted line still stands somewhere. Lines are equal if
    they are without white space at their ends. A null text is empty. Null ids come last.
    Rows that agree in id and text are one document: none is earlier than the other and
    they get the same result. Documents without repeated runs stay as they are, also very
    long ones; an empty table gives an empty result.
    """
    found = apart(docs, repeated_runs(docs, key, text, least_words))
    keep = docs.columns if keep is None else keep
    # the runs grow with the corpus: merged at every size, never broadcast
    joined = docs.join(found.hint("merge"), same_row(docs, found, key, text), "left")

    def make():
        def run(texts: list[str], matched: list) -> list[tuple]:
            rows = []
            for t, m in zip(texts, matched):
                gone = runs([(x["first"], x["last"]) for x in m or ()])
                n = sum(1 for x in t.encode().split(b"\n") if x.strip())
                rows.append((n, sum(b - a + 1 for a, b in gone), ",".join(f"{a}:{b}" for a, b in gone), without(t, gone) if gone else t))
            return rows

        return run

    return append(joined, make, [whole_text(text), F.col(found.columns[2])], FIELDS, name, keep)


def deduped(docs: DataFrame, key: str = "doc_id", text: str = "text", chars: str = "n_chars", least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without repeated runs; documents of which no word is left go.

    Columns as they were; ``chars``, where there is such a column, counts the new text.
    """
    name = free_name(docs, "dedup")
    out = dedup_lines(docs, key, text, least_words, None, name).where(f"{name}.n_deleted = 0 OR {name}.n_deleted < {name}.n_lines")
    changed = F.col(f"{name}.n_deleted") > 0
    new = {text: F.when(changed, F.col(f"{name}.text")).otherwise(F.col(text))}
    if chars in docs.columns:
        new[chars] = F.when(changed, F.length(f"{name}.text").cast(docs.schema[chars].dataType)).otherwise(F.col(chars))
    return out.select(*(new.get(c, F.col(c)).alias(c) for c in docs.columns))
