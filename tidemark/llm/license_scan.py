"""Licence detection by ordered signatures.

A text is lower-cased. Hundreds of patterns, of names, identifiers, addresses, grants and sentences of the licences' own texts, are tried
only if one of their keywords is in the text, whatever white space parts its words. Detections that overlap are resolved in order of
priority: one that lies within an accepted one, or shares text with an accepted one of higher priority, is suppressed. A grant
that is denied ("not licensed under ...") is suppressed by the denial, which has no label. Besides, base phrases are looked
for as consecutive words; their labels always stay.

Defined results: null and empty texts have no words and no labels, and score 0. Ties are resolved by label. Repeated rows
are treated alike. Texts are read whole, whatever their length. Other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import query, ready, table
from tidemark.llm.license_rules import DENIAL, RULES

#: Phrases as words, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
BASE_WORDS = tuple((tuple(word.encode() for word in phrase.split()), label) for phrase, label in BASE)
#: Priority of a denied grant.
DENIED = 5
#: Words of a lower-cased text in UTF-8: digits, a to z, and every byte of a character that is not ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[0x30:0x3A] = IN_WORD[0x61:0x7B] = IN_WORD[0x80:] = True


def lower_ascii(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "replace").lower()


def count_words(raw: bytes) -> int:
    inside = IN_WORD[np.frombuffer(raw, dtype=np.uint8)]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


def base_places(raw: bytes) -> list[tuple[int, str]]:
    """(first word, label) of every place where the words of a base phrase stand one after another."""
    if not any(all(word in raw for word in words) for words, _ in BASE_WORDS):
        return []
    words = WORD.findall(raw)
    places = []
    for phrase, label in BASE_WORDS:
        at = -1
        while True:
            try:
                at = words.index(phrase[0], at + 1)
            except ValueError:
                break
            if tuple(words[at : at + len(phrase)]) == phrase:
                places.append((at, label))
    return sorted(places)


def detections(text: str) -> list[tuple[int, int, int, float, str, str]]:
    """(start, end, priority, confidence, label, kind) of the signatures found in a lower-cased text, unresolved."""
    found = []
    flat = " ".join(text.split())
    for keywords, signatures in RULES:
        if any(keyword in flat for keyword in keywords):
            for sign in signatures:
                grant = sign.kind == "grant"
                for match in sign.pattern.finditer(text):
                    start, end = match.span()
                    if grant and (denied := DENIAL.search(text, max(0, start - 60), start)):
                        # Outranks the grant and what lies within it, and is no licence itself.
                        found.append((denied.start(), end, DENIED, 0.0, sign.label, "denial"))
                    else:
                        found.append((start, end, sign.priority, sign.confidence, sign.label, sign.kind))
    return found


def resolved(found: list[tuple[int, int, int, float, str, str]]) -> list[tuple[int, int, int, float, str, str]]:
    """What stays: by falling priority, unless it shares text with a higher priority that stays or lies within one of its own
    that stays; of equal places the first label.

    What stays of the higher priorities is one sorted list of places that are apart, looked up by bisection. Within a priority
    a place lies within another exactly if, in order of start, an earlier one ends no sooner. So the work is that of sorting.
    """
    kept: list[tuple[int, int, int, float, str, str]] = []
    starts, ends = [], []
    by_priority: dict[int, list] = {}
    for one in found:
        by_priority.setdefault(one[2], []).append(one)
    for priority in sorted(by_priority, reverse=True):
        stays, reach = [], -1
        for one in sorted(by_priority[priority], key=lambda d: (d[0], -d[1], d[4], d[5])):
            before = bisect_left(starts, one[1]) - 1
            if (before < 0 or ends[before] <= one[0]) and one[1] > reach:
                stays.append(one)
                reach = one[1]
        kept += stays
        places = sorted([*zip(starts, ends), *((one[0], one[1]) for one in stays)])
        starts, ends = [], []
        for start, end in places:
            if ends and start < ends[-1]:
                ends[-1] = max(ends[-1], end)
            else:
                starts.append(start)
                ends.append(end)
    return sorted(kept)


def scan(text: str | None) -> dict:
    raw = lower_ascii(text)
    places = base_places(raw)
    # A denied grant has done its work when it has suppressed what lies within it.
    kept = [detection for detection in resolved(detections(raw.decode("utf-8"))) if detection[5] != "denial"]
    base = {label for _, label in places}
    missed = 1.0
    for detection in kept:
        missed *= 1 - detection[3]
    for _ in places:
        missed *= 0.1
    return {
        "n_words": count_words(raw),
        "n_base": len(places),
        "first_word": places[0][0] if places else None,
        "last_word": places[-1][0] if places else None,
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | {detection[4] for detection in kept})),
        "score": 1 - missed,
        "spans": [{"start": d[0], "end": d[1], "label": d[4], "kind": d[5]} for d in kept],
    }


KIND = (
    "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double,"
    "spans:array<struct<start:bigint,end:bigint,label:string,kind:string>>>"
)
ARROW = pa.struct(
    [
        ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("kind", pa.string())]))),
    ]
)


def licenses(text: Column | str) -> Column:
    """What ``scan`` finds in a text. Places of spans are characters of the lower-cased text."""
    ready(SparkSession.active())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([scan(text) for text in texts.to_pylist()], ARROW)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, KIND)(text)


@query("op4_licenses")
def op4_licenses(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(ready(spark), folder, "documents")
    return documents.select("doc_id", licenses("text").alias("found")).select("doc_id", "found.*")
