"""License scan by ordered signature rules.

A text is reduced to its words (runs of letters, digits and other non-ASCII characters, A-Z in lower case)
joined by single spaces, so that line breaks and punctuation do not matter. Hundreds of hand-written
regular expressions look for license names, notices, tags and addresses in it. A rule is gated by its
keywords: it runs only on texts that hold all of them, so most texts meet no expression at all.

Detections may overlap: the notice "licensed under the apache license version 2 0" holds the name "apache
license". Rules are ordered by priority, exact notices before versioned names before bare names. A
detection that lies within one of at least equal priority is suppressed; detections that merely overlap
both stay. The four base phrases are reported wherever they stand, suppressed or not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

from .common import by_bytes

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# What a kind of rule says about a text, and its place in the order.
KINDS = {"notice": (40, 0.98), "tag": (30, 0.95), "versioned": (20, 0.9), "name": (10, 0.75), "weak": (5, 0.4)}


@dataclass(frozen=True)
class Rule:
    """A signature over normalised words. `keywords` are words that every match must hold."""

    name: str
    label: str
    kind: str
    keywords: frozenset[str]
    pattern: re.Pattern

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]

    @property
    def weight(self) -> float:
        return KINDS[self.kind][1]


GRANT = r"(?:licen[cs]ed|released|distributed|available|provided|published|covered|governed)(?: \w+){0,3}? (?:under|by)"
TERMS = r"(?:(?: the)?(?: terms| conditions)(?: and conditions)?(?: of)?)?(?: the| an?)?"
VERSION = r"(?: licen[cs]es?)?(?: version| ver| v)? ?"

# Families with versions: label, names as expressions over words with the keywords that they cannot do
# without, versions as words ("2 0") with the label's ending, and what stands for the family in tags.
VERSIONED = [
    ("gpl", [(r"gnu general public licen[cs]e", "gnu general public"), (r"gnu gpl", "gnu gpl"), (r"gpl", "gpl")],
     {"1": "1.0", "1 0": "1.0", "2": "2.0", "2 0": "2.0", "3": "3.0", "3 0": "3.0"}, "gpl"),
    ("lgpl", [(r"gnu lesser general public licen[cs]e", "gnu lesser general public"),
              (r"gnu library general public licen[cs]e", "gnu library general public"), (r"gnu lgpl", "gnu lgpl"),
              (r"lgpl", "lgpl")],
     {"2": "2.0", "2 0": "2.0", "2 1": "2.1", "3": "3.0", "3 0": "3.0"}, "lgpl"),
    ("agpl", [(r"gnu affero general public licen[cs]e", "gnu affero general public"),
              (r"affero general public licen[cs]e", "affero general public"), (r"agpl", "agpl")],
     {"1": "1.0", "1 0": "1.0", "3": "3.0", "3 0": "3.0"}, "agpl"),
    ("gfdl", [(r"gnu free documentation licen[cs]e", "gnu free documentation"), (r"gfdl", "gfdl")],
     {"1 1": "1.1", "1 2": "1.2", "1 3": "1.3"}, "gfdl"),
    ("apache", [(r"apache licen[cs]e", "apache"), (r"apache software licen[cs]e", "apache software"), (r"asl", "asl")],
     {"1": "1.0", "1 0": "1.0", "1 1": "1.1", "2": "2.0", "2 0": "2.0"}, "apache"),
    ("mpl", [(r"mozilla public licen[cs]e", "mozilla public"), (r"mpl", "mpl")],
     {"1 0": "1.0", "1 1": "1.1", "2": "2.0", "2 0": "2.0"}, "mpl"),
    ("epl", [(r"eclipse public licen[cs]e", "eclipse public"), (r"epl", "epl")],
     {"1 0": "1.0", "2": "2.0", "2 0": "2.0"}, "epl"),
    ("cddl", [(r"common development and distribution licen[cs]e", "common development distribution"),
              (r"cddl", "cddl")], {"1 0": "1.0", "1 1": "1.1"}, "cddl"),
    ("cpl", [(r"common public licen[cs]e", "common public")], {"1 0": "1.0"}, "cpl"),
    ("eupl", [(r"european union public licen[cs]e", "european union public"), (r"eupl", "eupl")],
     {"1 0": "1.0", "1 1": "1.1", "1 2": "1.2"}, "eupl"),
    ("osl", [(r"open software licen[cs]e", "open software")],
     {"1 0": "1.0", "2 0": "2.0", "2 1": "2.1", "3 0": "3.0"}, "osl"),
    ("afl", [(r"academic free licen[cs]e", "academic free")],
     {"1 1": "1.1", "2 0": "2.0", "2 1": "2.1", "3 0": "3.0"}, "afl"),
    ("artistic", [(r"artistic licen[cs]e", "artistic")], {"1 0": "1.0", "2 0": "2.0"}, "artistic"),
    ("boost", [(r"boost software licen[cs]e", "boost software")], {"1 0": "1.0"}, "bsl"),
    ("bsl", [(r"business source licen[cs]e", "business source")], {"1 0": "1.0", "1 1": "1.1"}, "busl"),
    ("elastic", [(r"elastic licen[cs]e", "elastic")], {"1 0": "1.0", "2 0": "2.0"}, "elastic"),
    ("sspl", [(r"server side public licen[cs]e", "server side public"), (r"sspl", "sspl")], {"1": "1.0", "1 0": "1.0"}, "sspl"),
    ("cecill", [(r"cecill(?: free software licen[cs]e)?", "cecill")],
     {"1 0": "1.0", "1 1": "1.1", "2 0": "2.0", "2 1": "2.1"}, "cecill"),
    ("ofl", [(r"sil open font licen[cs]e", "sil font"), (r"open font licen[cs]e", "open font")],
     {"1 0": "1.0", "1 1": "1.1"}, "ofl"),
    ("zpl", [(r"zope public licen[cs]e", "zope")], {"1 1": "1.1", "2 0": "2.0", "2 1": "2.1"}, "zpl"),
    ("psf", [(r"python software foundation licen[cs]e", "python software foundation")], {"2": "2.0", "2 0": "2.0"}, "psf"),
    ("php", [(r"php licen[cs]e", "php")], {"3 0": "3.0", "3 01": "3.01"}, "php"),
    ("odbl", [(r"open database licen[cs]e", "open database"), (r"odbl", "odbl")], {"1 0": "1.0"}, "odbl"),
    ("odc-by", [(r"open data commons attribution licen[cs]e", "open data commons attribution")], {"1 0": "1.0"}, "odc by"),
    ("openrail", [(r"open rail(?: m)?", "open rail"), (r"openrail(?: m)?", "openrail")], {"1": "1.0", "1 0": "1.0"}, "openrail"),
    ("ms-pl", [(r"microsoft public licen[cs]e", "microsoft public")], {"1 0": "1.0"}, "ms pl"),
    ("ms-rl", [(r"microsoft reciprocal licen[cs]e", "microsoft reciprocal")], {"1 0": "1.0"}, "ms rl"),
    ("wtfpl", [(r"do what the fuck you want to public licen[cs]e", "what want public"), (r"wtfpl", "wtfpl")],
     {"1": "1.0", "2": "2.0"}, "wtfpl"),
    ("opl", [(r"open publication licen[cs]e", "open publication")], {"1 0": "1.0"}, "opubl"),
    ("upl", [(r"universal permissive licen[cs]e", "universal permissive")], {"1 0": "1.0"}, "upl"),
    ("vim", [(r"vim licen[cs]e", "vim")], {}, "vim"),
    ("mit", [(r"mit licen[cs]e", "mit"), (r"expat licen[cs]e", "expat")], {}, "mit"),
    ("isc", [(r"isc licen[cs]e", "isc")], {}, "isc"),
    ("zlib", [(r"zlib(?: libpng)? licen[cs]e", "zlib")], {}, "zlib"),
    ("x11", [(r"x11 licen[cs]e", "x11")], {}, "x11"),
    ("ncsa", [(r"(?:university of illinois )?ncsa open source licen[cs]e", "ncsa")], {}, "ncsa"),
    ("postgresql", [(r"postgresql licen[cs]e", "postgresql")], {}, "postgresql"),
    ("beerware", [(r"beer ?ware licen[cs]e", "beerware|beer ware")], {}, "beerware"),
    ("unlicense", [(r"the unlicen[cs]e", "the")], {}, "unlicense"),
    ("bsd", [(r"bsd licen[cs]e", "bsd"), (r"bsd style licen[cs]e", "bsd style")], {}, ""),
    ("cc0", [(r"cc0", "cc0"), (r"creative commons zero", "creative commons zero")], {"1 0": "1.0"}, "cc0"),
    ("public-domain", [(r"public domain dedication", "public domain dedication")], {}, ""),
]

# The parts of a Creative Commons license, as letters and in full; 1.0 to 4.0 follow by rule.
CREATIVE = [
    ("cc-by", r"by", r"attribution"),
    ("cc-by-sa", r"by sa", r"attribution share ?alike"),
    ("cc-by-nd", r"by nd", r"attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc", r"by nc", r"attribution non ?commercial"),
    ("cc-by-nc-sa", r"by nc sa", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", r"by nc nd", r"attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
]
CREATIVE_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Sentences out of license texts and headers: label, expression, keywords.
NOTICES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "permission granted obtaining"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission distribute purpose"),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice this list of conditions", "redistributions reproduce"),
    ("bsd-3-clause", r"neither the name of (?:\w+ ){1,12}?nor the names of its contributors may be used to endorse", "neither contributors endorse"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising mentioning"),
    ("bsd-2-clause", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd) licen[cs]e", "bsd|freebsd"),
    ("bsd-3-clause", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[cs]e", "bsd"),
    ("bsd-4-clause", r"(?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd) licen[cs]e", "bsd"),
    ("zlib", r"in no event will the authors be held liable for any damages arising from the use of this software", "authors liable damages"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", r"(?:released|placed|dedicated|put|is) (?:\w+ )?(?:in|into|to) the public domain", "public domain"),
    ("public-domain", r"this work is in the public domain", "public domain"),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[cs]e", "compliance except"),
    ("apache-2.0", r"apache org licenses licen[cs]e 2 0", "apache org"),
    ("gpl-or-later", r"(?:either version \d (?:of the licen[cs]e )?)or (?:\w+ ){0,3}any later version", "later version"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", "redistribute gnu"),
    ("lgpl", r"under the terms of the gnu (?:lesser|library) general public licen[cs]e", "terms gnu general"),
    ("agpl", r"under the terms of the gnu affero general public licen[cs]e", "terms gnu affero"),
    ("gpl", r"gnu org (?:licenses|copyleft)(?: gpl)?", "gnu org"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e", "source subject mozilla"),
    ("mpl", r"mozilla org mpl", "mozilla mpl"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e", "accompanying eclipse"),
    ("boost-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "permission organization accompanying"),
    ("wtfpl-2.0", r"you just do what the fuck you want to", "just what want"),
    ("beerware", r"you can buy me a beer in return", "buy beer return"),
    ("cc0-1.0", r"to the extent possible under law (?:\w+ ){1,10}?(?:has|have) waived all copyright", "extent waived"),
    ("cc0-1.0", r"creativecommons org publicdomain zero 1 0", "creativecommons publicdomain"),
    ("all-rights-reserved", r"all rights reserved", "rights reserved"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary confidential"),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|use|distribution) (?:\w+ ){0,6}?is strictly prohibited", "strictly prohibited"),
    ("non-commercial", r"for (?:personal and )?non ?commercial use only", "use only"),
    ("non-commercial", r"not for commercial use", "not commercial use"),
    ("evaluation-only", r"for evaluation purposes only", "evaluation purposes"),
    ("research-only", r"for (?:academic|research)(?: and (?:academic|research))? (?:use|purposes) only", "for only"),
    ("llama-community", r"llama (?:\d )?(?:\d )?community licen[cs]e", "llama community"),
    ("ogl", r"open government licen[cs]e", "open government"),
    ("ngc", r"used with permission of the (?:author|authors|copyright holder|publisher)", "used permission"),
]


def words_of(raw: bytes) -> list[bytes]:
    """The words of a text: A-Z in lower case, runs of digits, letters and bytes beyond ASCII."""
    return raw.translate(_TABLE).split()


_TABLE = bytes(
    c + 32 if 0x41 <= c <= 0x5A
    else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80
    else 0x20
    for c in range(256)
)


def _compiled(expression: str) -> re.Pattern:
    """Over bytes of words with single spaces around each; matches begin and end at words."""
    return re.compile(rf"(?<= )(?:{expression})(?= )".replace(r"\w", r"[^ ]").encode())


@cache
def rules() -> tuple[Rule, ...]:
    """All rules, those of higher priority first; within a priority as written."""
    found: list[Rule] = []

    def add(label: str, kind: str, expression: str, keywords: str) -> None:
        # "a b": both words; "a|b": a rule each. Keywords that are themselves expressions gate on nothing.
        for option in keywords.split("|"):
            words = frozenset(w for w in option.split() if w.isalnum())
            found.append(Rule(f"{label}/{kind}/{len(found)}", label, kind, words, _compiled(expression)))

    for label, expression, keywords in NOTICES:
        weak = label in ("all-rights-reserved", "ngc")
        add(label, "weak" if weak else "notice", expression, keywords)
    for label, names, versions, tag in VERSIONED:
        for expression, keywords in names:
            add(label, "notice", rf"{GRANT}{TERMS} {expression}", keywords)
            add(label, "name", expression, keywords)
            for version, ending in versions.items():
                of = rf"{expression}{VERSION}{version}(?: only| or later| or any later version)?(?! \d)"
                # The version may be glued to a letter ("v3"), so it is no keyword.
                add(f"{label}-{ending}", "versioned", of, keywords)
                add(f"{label}-{ending}", "notice", rf"{GRANT}{TERMS} {of}", keywords)
        if tag:
            add(label, "tag", rf"spdx licen[cs]e identifier {tag}", f"spdx identifier {tag}")
            for version, ending in versions.items():
                add(f"{label}-{ending}", "tag", rf"spdx licen[cs]e identifier {tag} {version}(?: only| or later)?(?! \d)",
                    f"spdx identifier {tag} {version}")
    for label, letters, full in CREATIVE:
        last = r"(?! (?:sa|nd|nc)\b)"
        add(label, "name", rf"(?:cc|creative commons) {letters}{last}", f"cc {letters}|creative commons {letters}")
        add(label, "name", rf"creative commons {full}(?! (?:non ?commercial|share ?alike|no ?deriv))", "creative commons")
        add(label, "notice", rf"{GRANT}{TERMS} (?:cc|creative commons) {letters}{last}", f"cc {letters}|creative commons {letters}")
        for version in CREATIVE_VERSIONS:
            ending = f"{label}-{version.replace(' ', '.')}"
            of = rf"(?:cc|creative commons) {letters} {version}"
            long = rf"creative commons {full}(?: international| unported| generic)?(?: public)?{VERSION}{version}"
            add(ending, "versioned", of, f"cc {letters} {version}|creative commons {letters} {version}")
            add(ending, "notice", rf"{GRANT}{TERMS} {of}", f"cc {letters} {version}|creative commons {letters} {version}")
            add(ending, "versioned", long, "creative commons")
            add(ending, "notice", rf"{GRANT}{TERMS} {long}", "creative commons")
            add(ending, "notice", rf"creativecommons org licenses {letters} {version}", f"creativecommons licenses {version}")
    return tuple(sorted(found, key=lambda r: -r.priority))


class Scanner:
    """Detections in one text."""

    def __init__(self):
        self.rules = rules()
        self.base = [
            (phrase, label, frozenset(w.encode() for w in phrase.split()), re.compile(rf"(?<= ){phrase}(?= )".encode()))
            for phrase, label in BASE.items()
        ]
        # A rule is found by its rarest-looking keyword, the longest, and then asked for the others.
        self.gates: dict[bytes, list[tuple[int, Rule, frozenset[bytes]]]] = {}
        self.always: list[tuple[int, Rule, frozenset[bytes]]] = []
        for order, rule in enumerate(self.rules):
            needs = frozenset(w.encode() for w in rule.keywords)
            entry = (order, rule, needs)
            if needs:
                self.gates.setdefault(max(needs, key=lambda w: (len(w), w)), []).append(entry)
            else:
                self.always.append(entry)
        self.gate_words = frozenset(self.gates) | {w for _, _, ws, _ in self.base for w in ws}

    def __call__(self, words: list[bytes]) -> tuple[list[tuple], list[tuple]]:
        """Base places and the rules' detections, both as (start, end, label, rule, priority, weight), by words."""
        present = self.gate_words.intersection(words)
        if not present and not self.always:
            return [], []
        all_words = set(words)
        chosen = sorted(
            (entry for w in present for entry in self.gates.get(w, ()) if entry[2] <= all_words),
            key=lambda e: e[0],
        )
        chosen = self.always + chosen
        phrases = [x for x in self.base if x[2] <= all_words]
        if not chosen and not phrases:
            return [], []
        text = b" " + b" ".join(words) + b" "
        starts = np.cumsum([1] + [len(w) + 1 for w in words[:-1]])  # a word's place in `text`

        def span(m: re.Match) -> tuple[int, int]:
            return int(np.searchsorted(starts, m.start())), int(np.searchsorted(starts, m.end()))

        base = [
            (*span(m), label, f"base/{phrase}", 0, 0.75)
            for phrase, label, _, pattern in phrases for m in pattern.finditer(text)
        ]
        hits = [
            (*span(m), rule.label, rule.name, rule.priority, rule.weight)
            for _, rule, _ in chosen for m in rule.pattern.finditer(text)
        ]
        return sorted(base), suppressed(hits)


def suppressed(hits: list[tuple]) -> list[tuple]:
    """Detections without those inside one of at least equal priority.

    Of equal intervals the first in the order stays: higher priority, then the rule written earlier.
    """
    # Longer ones first among those that start alike; then whatever ends no later than a kept one with enough
    # priority, started no later, lies within it.
    ordered = sorted(enumerate(hits), key=lambda x: (x[1][0], -x[1][1], -x[1][4], x[0]))
    kept: list[tuple] = []
    furthest: dict[int, int] = {}  # priority -> the furthest end of a detection seen with it
    for _, hit in ordered:
        if not any(end >= hit[1] for priority, end in furthest.items() if priority >= hit[4]):
            kept.append(hit)
        furthest[hit[4]] = max(furthest.get(hit[4], -1), hit[1])
    return kept


DETECTION = StructType([
    StructField("start", LongType()), StructField("end", LongType()), StructField("label", StringType()),
    StructField("rule", StringType()), StructField("priority", IntegerType()),
    StructField("weight", DoubleType()), StructField("base", BooleanType()),
])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, detections, score.

    `detections` has the base places and what the rules found after suppression, by start, with spans in
    words (from 0, end exclusive). `score` says how sure it is that the text states a license: the chance
    that at least one kept detection is right, their weights taken as independent but each label counted once; 0
    without detections. A null or empty text has no words and no detections. Repeated rows and ids are
    scanned row by row; other columns are ignored; an empty table gives no rows.
    """
    schema = StructType([
        StructField("doc_id", docs.schema[id_col].dataType), StructField("n_words", LongType()),
        StructField("detections", ArrayType(DETECTION)), StructField("score", DoubleType()),
    ])
    names = DETECTION.fieldNames()
    detection = pa.struct([
        ("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("rule", pa.string()),
        ("priority", pa.int32()), ("weight", pa.float64()), ("base", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for piece in by_bytes(batch, 1):
                sizes, found, scores = [], [], []
                for raw in piece.column(1).cast(pa.binary()):
                    words = words_of(raw.as_py() or b"")
                    base, hits = scanner(words)
                    rows = sorted([(*h, True) for h in base] + [(*h, False) for h in hits])
                    best: dict[str, float] = {}
                    for h in rows:
                        best[h[2]] = max(best.get(h[2], 0.0), h[5])
                    doubt = 1.0
                    for label in sorted(best):
                        doubt *= 1 - best[label]
                    sizes.append(len(words))
                    found.append([dict(zip(names, h)) for h in rows])
                    scores.append(1 - doubt)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(detection)),
                     pa.array(scores, pa.float64())],
                    names=schema.names,
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)
