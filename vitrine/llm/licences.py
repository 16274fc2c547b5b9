"""License scans with ordered signature rules.

A rule is a regular expression over the lower-cased text, with a label, a priority, a strength and a keyword without
which it can't match. A chunk of documents, then a document, is searched for the keywords first; only rules whose
keyword occurs run. Detections are then resolved: in order of priority, then length, then place, one that lies inside
an interval already taken is suppressed. The four base phrases are reported in any case.

Phrases are sequences of words: any run of characters that are neither ASCII letters or digits nor non-ASCII may stand
between two words, and a phrase neither begins nor ends inside a word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm import words as W
from vitrine.llm.arrow import add_columns

_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_BEGIN, _END = rb"(?<![0-9a-z\x80-\xff])", rb"(?![0-9a-z\x80-\xff])"

BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keyword: bytes
    priority: int      # smaller goes first
    strength: float    # how sure a lone detection is, below 1


def phrase(words: str) -> bytes:
    """Pattern of a phrase; ``a|b`` in a word is a choice, a word in brackets may be absent."""
    out = b""
    for word in words.split():
        choice = b"|".join(re.escape(w.encode()) for w in word.strip("[]").split("|"))
        if word.startswith("["):
            out += rb"(?:" + _GAP + rb"(?:" + choice + rb"))?"
        else:
            out += (_GAP if out else b"") + (rb"(?:" + choice + rb")" if b"|" in choice else choice)
    return _BEGIN + out + _END


def keyword(words: str) -> bytes:
    """The longest word that a phrase can't do without."""
    return max((w for w in words.split() if w[0] != "[" and "|" not in w), key=len).encode()


def _version(number: str) -> str:
    """A version such as 2.0 as words of a phrase; a final zero may be absent."""
    major, _, minor = number.partition(".")
    return f"{major} [{minor}]" if minor == "0" else f"{major} {minor}" if minor else major


def _families() -> list[tuple[str, str, list[str], list[str]]]:
    """Label, versions, long and short phrases of the licence families ({v}: the version's words)."""
    named = "[version|v|ver]"
    return [
        ("gpl", "1 2 3", [f"gnu general public license {named} {{v}}", f"general public licence {named} {{v}}"],
         ["gpl v{n}", "gplv{n}", "gpl {v}", "gnu gpl {v}", "gpl version {v}"]),
        ("lgpl", "2 2.1 3", [f"gnu lesser general public license {named} {{v}}",
                                       f"lesser general public license {named} {{v}}"],
         ["lgpl v{n}", "lgplv{n}", "lgpl {v}", "gnu lgpl {v}", "lgpl version {v}"]),
        ("agpl", "1 3", [f"gnu affero general public license {named} {{v}}",
                                   f"affero general public license {named} {{v}}"],
         ["agpl v{n}", "agplv{n}", "agpl {v}", "gnu agpl {v}", "agpl version {v}"]),
        ("gfdl", "1.1 1.2 1.3", [f"gnu free documentation license {named} {{v}}",
                                                  f"free documentation license {named} {{v}}"], ["gfdl {v}"]),
        ("apache", "1.0 1.1 2.0", [f"apache license {named} {{v}}", f"apache software license {named} {{v}}",
                                             f"licensed under the apache license {named} {{v}}",
                                             f"apache public license {named} {{v}}"], ["apache {v}", "asl {v}"]),
        ("mpl", "1.0 1.1 2.0", [f"mozilla public license {named} {{v}}"], ["mpl {v}", "mpl v{n}"]),
        ("epl", "1.0 2.0", [f"eclipse public license {named} {{v}}"], ["epl {v}", "epl v{n}"]),
        ("cddl", "1.0 1.1", [f"common development and distribution license {named} {{v}}"], ["cddl {v}"]),
        ("eupl", "1.0 1.1 1.2", [f"european union public licence|license {named} {{v}}"], ["eupl {v}"]),
        ("artistic", "1.0 2.0", [f"artistic license {named} {{v}}", f"perl artistic license {named} {{v}}"], []),
        ("afl", "1.1 2.0 2.1 3.0", [f"academic free license {named} {{v}}"], ["afl {v}"]),
        ("osl", "1.0 2.0 2.1 3.0", [f"open software license {named} {{v}}"], ["osl {v}"]),
        ("cecill", "1 2 2.1", [f"cecill license {named} {{v}}", "cecill {v}"], []),
        ("bsl", "1.0", [f"boost software license {named} {{v}}"], []),
        ("zpl", "1.1 2.0 2.1", [f"zope public license {named} {{v}}"], ["zpl {v}"]),
        ("python", "2.0", [f"python software foundation license {named} {{v}}", f"psf license {named} {{v}}"], []),
        ("lppl", "1.0 1.1 1.2", [f"latex project public license {named} {{v}}"], ["lppl {v}"]),
        ("ofl", "1.0 1.1", [f"sil open font license {named} {{v}}", f"open font license {named} {{v}}"], ["ofl {v}"]),
        ("odbl", "1.0", [f"open database license {named} {{v}}", f"open data commons open database license {named} {{v}}"],
         ["odbl {v}"]),
        ("ms-pl", "", ["microsoft public license"], ["ms pl"]),
        ("ms-rl", "", ["microsoft reciprocal license"], ["ms rl"]),
        ("mit", "", ["the mit license", "mit license", "mit licensed", "licensed under the mit license",
                            "released under the mit license", "licensed under mit"], ["mit expat", "expat license"]),
        ("mit", "", ["permission is hereby granted free of charge to any person obtaining a copy"], []),
        ("isc", "", ["isc license", "isc licence", "licensed under the isc license"], []),
        ("isc", "", ["permission to use copy modify and or distribute this software for any purpose"], []),
        ("bsd", "", ["bsd license", "bsd licence", "bsd style license", "berkeley software distribution license",
                            "licensed under the bsd license"], []),
        ("bsd-2-clause", "", ["simplified bsd license", "freebsd license", "bsd 2 clause [license]",
                                     "two clause bsd [license]", "2 clause bsd [license]"], []),
        ("bsd-3-clause", "", ["new bsd license", "modified bsd license", "revised bsd license", "bsd 3 clause [license]",
                                     "three clause bsd [license]", "3 clause bsd [license]"], []),
        ("bsd-4-clause", "", ["original bsd license", "bsd 4 clause [license]", "four clause bsd [license]"], []),
        ("bsd", "", ["redistribution and use in source and binary forms with or without modification"], []),
        ("zlib", "", ["zlib license", "zlib libpng license", "zlib licence"], []),
        ("unlicense", "", ["the unlicense", "released under the unlicense"], []),
        ("unlicense", "", ["free and unencumbered software released into the public domain"], []),
        ("wtfpl", "", ["wtfpl"], []),
        ("public-domain", "", ["released into the public domain", "dedicated to the public domain",
                                         "in the public domain"], []),
        ("cc0-1.0", "", ["cc0 1 0", "cc0 [1] [0] universal", "creative commons zero", "cc0"], []),
        ("proprietary", "", ["all rights reserved"], []),
        ("proprietary", "", ["proprietary and confidential", "proprietary license"], []),
        ("gpl", "", ["gnu general public license", "general public license", "gnu general public licence"], []),
        ("gpl", "", ["gnu gpl", "gpl license", "gpl compatible"], []),
        ("lgpl", "", ["gnu lesser general public license", "lesser general public license"], []),
        ("lgpl", "", ["gnu library general public license", "library general public license"], []),
        ("agpl", "", ["gnu affero general public license", "affero general public license"], []),
        ("apache", "", ["apache license", "apache software license", "licensed under the apache license"], []),
        ("mpl", "", ["mozilla public license"], []),
        ("epl", "", ["eclipse public license"], []),
        ("artistic", "", ["artistic license"], []),
        ("eupl", "", ["european union public licence|license"], []),
        ("cc", "", ["creative commons license", "creative commons licence", "creative commons"], []),
    ]


def rules() -> list[Rule]:
    """All rules in their order; versions and Creative Commons elements are written out from their families."""
    out: list[Rule] = []

    def add(label: str, words: str, priority: int, strength: float) -> None:
        out.append(Rule(label, re.compile(phrase(words)), keyword(words), priority, strength))

    families = _families()
    for label, versions, long, short in families:
        for number in versions.split():
            own, tag = f"{label}-{number}", number.replace(".", "")
            add(own, f"spdx license identifier {label} {_version(number)} [only|or] [later]", 0, 0.98)
            joined = [words.replace("[version|v|ver] {v}", "v{v}") for words in long]   # v2 as one word
            for words in dict.fromkeys(long + joined):
                filled = words.replace("{v}", _version(number))
                add(own, filled, 2, 0.9)
                if label in ("gpl", "lgpl", "agpl", "gfdl"):
                    add(f"{own}-or-later", f"{filled} or [at] [your] [option] [any] later [version]", 1, 0.9)
            for words in short:
                filled = words.replace("{v}", _version(number)).replace("{n}", number if "." not in number else tag)
                add(own, filled, 3, 0.7)
        if not versions:
            for words in long:
                add(label, words, 4 if len(words.split()) > 2 else 5, 0.8 if len(words.split()) > 2 else 0.6)
            for words in short:
                add(label, words, 5, 0.5)
            add(label, f"spdx license identifier {label.replace('-', ' ')}", 0, 0.95)
    elements = {"by": "attribution", "by sa": "attribution sharealike", "by nd": "attribution noderivatives",
                "by nc": "attribution noncommercial", "by nc sa": "attribution noncommercial sharealike",
                "by nc nd": "attribution noncommercial noderivatives"}
    for short, long in elements.items():
        label = "cc-" + short.replace(" ", "-")
        for number in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            version = _version(number) if number != "2.5" else "2 5"
            add(f"{label}-{number}", f"cc {short} {version}", 2, 0.9)
            add(f"{label}-{number}", f"creative commons {long} {version}", 2, 0.9)
            add(f"{label}-{number}", f"creativecommons org licenses {short} {number.replace('.', ' ')}", 1, 0.95)
        add(label, f"cc {short}", 4, 0.6)
        add(label, f"creative commons {long}", 4, 0.7)
    return sorted(out, key=lambda r: r.priority)


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    priority: int
    strength: float


def resolve(found: list[Detection]) -> list[Detection]:
    """Detections left when those inside an interval taken before them are suppressed, in order of place."""
    kept: list[Detection] = []
    for d in sorted(found, key=lambda d: (d.priority, d.start - d.end, d.start, d.label)):
        if not any(k.start <= d.start and d.end <= k.end for k in kept):
            kept.append(d)
    return sorted(kept, key=lambda d: (d.start, d.end))


FIELDS = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
          "detections array<struct<label: string, first: long, last: long>>")


def _scan(part: pa.RecordBatch) -> dict[str, pa.Array]:
    signatures = W.worker_cache("licence_rules", rules)
    base = [(re.compile(phrase(words)), label, keyword(words)) for words, label in BASE]
    keywords = sorted({r.keyword for r in signatures} | {k for _, _, k in base})
    words = W.split(part.column("text"), W.ALNUM, W.LOWER, hashed=False)
    whole = words.data.tobytes()
    offsets = W.text_bytes(part.column("text"))[1].tolist()
    likely = [k for k in keywords if k in whole]
    columns: dict[str, list] = {k: [] for k in ("n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")}
    for row in range(part.num_rows):
        text = whole[offsets[row]:offsets[row + 1]]
        there = {k for k in likely if k in text}
        start = words.start[words.first[row]:words.first[row + 1]] - offsets[row]
        places, base_labels, found = [], set(), []
        if there:
            for pattern, label, needed in base:
                hits = [m.start() for m in pattern.finditer(text)] if needed in there else []
                places += hits
                base_labels |= {label} if hits else set()
            found = resolve([Detection(m.start(), m.end(), r.label, r.priority, r.strength)
                             for r in signatures if r.keyword in there for m in r.pattern.finditer(text)])
        at = np.searchsorted(start, places)
        columns["n_base"].append(len(places))
        columns["first_word"].append(int(at.min()) if len(at) else None)
        columns["last_word"].append(int(at.max()) if len(at) else None)
        columns["base_labels"].append(",".join(sorted(base_labels)))
        columns["labels"].append(",".join(sorted(base_labels | {d.label for d in found})))
        columns["score"].append(1 - float(np.prod([1 - d.strength for d in found])) if found else 0.6 * bool(places))
        columns["detections"].append([{"label": d.label, "first": int(np.searchsorted(start, d.start)),
                                       "last": int(np.searchsorted(start, d.end)) - 1} for d in found])
    kinds = {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
             "detections": pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))}
    return {"n_words": pa.array(words.counts(), pa.int64())} | \
        {k: pa.array(v, kinds.get(k, pa.int64())) for k, v in columns.items()}


def scan_licences(docs: DataFrame) -> DataFrame:
    """``docs`` (text, ...) with words, base phrases, labels, score and detections of each whole text.

    The score is 1 minus the product of (1 - strength) over the detections left. Null and empty texts have no words, no
    labels and score 0. Columns of ``docs`` with the added names are replaced.
    """
    return add_columns(docs, FIELDS, _scan)
