"""License scans: fuzzy search for short notices."""

from __future__ import annotations

import bisect
import itertools
from collections.abc import Iterator

from pyspark.sql import DataFrame, functions as F

from sitefold.llm import common as C

#: A word of a notice: a-z, 0-9 and whatever is not ASCII, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The base phrases and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: Short notices as words, with the label each stands for.
NOTICES = (
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("gpl", "under the terms of the gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)


def edits_allowed(notice: str, edits: int = 3, seed: int = 8) -> int:
    """Edits allowed for a notice: at most ``edits``, and few enough that each seed has ``seed`` characters."""
    return max(0, min(edits, len(notice) // seed - 1))


class Matcher:
    """Finds all notices in a text whose words are joined by blanks.

    A notice with at most ``k`` edits is cut into ``k + 1`` seeds, one of which occurs unchanged in any match (pigeonhole).
    One automaton finds all seeds of all notices; around each, the ``regex`` library looks for the best match within ``k``
    edits. Of overlapping matches the one with the smallest share of edits stays.
    """

    def __init__(self, notices: tuple[tuple[str, str], ...] = NOTICES, edits: int = 3):
        import ahocorasick
        import regex

        self.seeds = ahocorasick.Automaton()
        self.notices = []
        places: dict[str, list[tuple[int, int]]] = {}
        for i, (label, notice) in enumerate(notices):
            k = edits_allowed(notice, edits)
            self.notices.append((label, len(notice), k, regex.compile(f"(?b)(?:{regex.escape(notice)}){{e<={k}}}")))
            cuts = [len(notice) * c // (k + 1) for c in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                places.setdefault(notice[a:b], []).append((i, a))
        for seed, where in places.items():
            self.seeds.add_word(seed, (len(seed), where))
        self.seeds.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, str, int, float]]:
        """(start, end, label, edits, score) of the matches, in order."""
        tried: dict[int, int] = {}  # by notice: end of the stretch that is settled
        found = []
        for last, (length, where) in self.seeds.iter(text):
            for i, at in where:
                label, size, k, pattern = self.notices[i]
                start = max(0, last + 1 - length - at - k)
                end = last + 1 - length - at + size + k
                if last + 1 <= tried.get(i, -1):
                    continue
                m = pattern.search(text, start, end)
                if m:
                    edits = sum(m.fuzzy_counts)
                    found.append((edits / size, m.start(), m.end(), label, edits))
                    tried[i] = m.end()
        out: list[tuple[int, int, str, int, float]] = []
        taken = bytearray(len(text) if found else 0)  # a byte per character of the matches kept so far
        for share, a, b, label, edits in sorted(found):
            if taken.find(1, a, b) < 0:
                taken[a:b] = b"\1" * (b - a)
                out.append((a, b, label, edits, 1 - share))
        return sorted(out)


class Numbers:
    """Which word a place of a text belongs to; the text starts with a blank and parts its words by one."""

    def __init__(self, words: list[str]):
        self.words = words
        self.blanks: list[int] | None = None  # places of all blanks, listed once a text has a hit

    def before(self, at: int) -> int:
        """Blanks before ``at``."""
        if self.blanks is None:
            self.blanks = [0, *itertools.accumulate(len(w) + 1 for w in self.words)]
        return bisect.bisect_left(self.blanks, at)


def place(text: str, numbers: Numbers, start: int, end: int, label: str, edits: int, score: float) -> dict:
    """A match in words."""
    start += text[start] == " "
    end -= text[end - 1] == " "
    return {"label": label, "start_word": numbers.before(start) - 1, "end_word": numbers.before(end), "edits": edits, "found": text[start:end]}


def scan(docs: DataFrame, *, notices: tuple[tuple[str, str], ...] = NOTICES, phrases: dict[str, str] | None = None, edits: int = 3,
         id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Base phrases and fuzzy notices of every whole text, one row per document.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score (that of the best match; 1 for a base
    phrase, 0 without any) and ``spans``: label, first word, word after the last, edits and the text found. Each row is read on
    its own, nothing is shuffled; time and memory grow with the length of a text, however many hits it has. A null text is the empty
    text. Of overlapping matches with an equal share of edits the first stays. Repeated rows and rows without an id stay rows; an empty
    table gives no rows. Only the two named columns are read.
    """
    phrases = PHRASES if phrases is None else phrases
    span = "array<struct<label:string,start_word:bigint,end_word:bigint,edits:bigint,found:string>>"
    out = C.schema(doc_id="long", n_words="long", n_base="long", first_word="long", last_word="long", base_labels="string", labels="string",
                   score="double", spans=span)

    def scanned(batches: Iterator) -> Iterator:
        import re

        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        words, matcher, arrow = re.compile(WORD).findall, Matcher(notices, edits), to_arrow_schema(out)
        rows: list[dict] = []
        for doc, raw in C.rows_of(batches, "id", "text"):
            # bytes.lower() only knows ASCII, as asked.
            own = words(raw.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
            text, numbers = f" {' '.join(own)} ", Numbers(own)
            base: list[tuple[int, str]] = []
            for phrase, label in phrases.items():
                at = text.find(f" {phrase} ")
                while at >= 0:
                    base.append((numbers.before(at + 1) - 1, label))
                    at = text.find(f" {phrase} ", at + 1)
            spans = matcher.find(text)
            labels = {x for _, x in base}
            rows.append({
                "doc_id": doc, "n_words": len(own), "n_base": len(base), "first_word": min(base)[0] if base else None, "last_word": max(base)[0] if base else None,
                "base_labels": ",".join(sorted(labels)), "labels": ",".join(sorted(labels | {s[2] for s in spans})),
                "score": 1.0 if base else max([0.0, *(s[4] for s in spans)]),
                "spans": [place(text, numbers, *s) for s in spans],
            })
            if len(rows) >= 1024:
                yield pa.RecordBatch.from_pylist(rows, arrow)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist(rows, arrow)

    return docs.select(F.col(id_column).cast("long").alias("id"), C.text_of(text_column).alias("text")).mapInArrow(scanned, out)
