"""License scans: ordered signature rules over whole texts.

A text becomes its lower-cased words, one blank apart, and rules are regular
expressions over that. Each rule names the words it can't do without; only
rules whose words all occur in the text are run. Detections are ordered by
priority (grant texts, identifiers, license notices, plain mentions); one whose
interval of words lies inside that of a better or longer one is suppressed.
Three base phrases are reported wherever they stand and are never suppressed.
Every text is scanned on its own in Arrow batches: nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

#: Base phrases and their labels.
BASE_PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2",
                "cc by nc": "cc-by-nc"}

#: label, the words that must occur, and the name as a pattern over blank-separated words.
FAMILIES = [
    ("mit", "mit", r"mit(?: expat)?"),
    ("mit-0", "mit", r"mit (?:no attribution|0)"),
    ("x11", "x11", r"x11"),
    ("isc", "isc", r"isc"),
    ("bsd-0", "0bsd", r"0bsd"),
    ("bsd-2", "bsd", r"(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd)"),
    ("bsd-3", "bsd", r"(?:3 clause bsd|bsd 3 clause|new bsd|revised bsd|modified bsd)"),
    ("bsd-4", "bsd", r"(?:4 clause bsd|bsd 4 clause|original bsd)"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version)? 1 1"),
    ("apache-2", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)?"),
    ("gpl-2", "general", r"(?:gnu )?general public license(?: version| v)? 2(?: 0)?(?: or later)?"),
    ("gpl-3", "general", r"(?:gnu )?general public license(?: version| v)? 3(?: 0)?(?: or later)?"),
    ("gpl", "general", r"(?:gnu )?general public license"),
    ("gpl-2", "gplv2", r"gplv2"),
    ("gpl-3", "gplv3", r"gplv3"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl (?:v|version )?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl (?:v|version )?3(?: 0)?(?: only| or later)?"),
    ("gpl", "gpl", r"(?:gnu )?gpl"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 2 1"),
    ("lgpl-3", "lesser", r"(?:gnu )?lesser general public license(?: version| v)? 3(?: 0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public license"),
    ("lgpl-2", "library", r"(?:gnu )?library general public license"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl (?:v|version )?2 1(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl (?:v|version )?3(?: 0)?(?: only| or later)?"),
    ("lgpl", "lgpl", r"(?:gnu )?lgpl"),
    ("agpl-3", "affero", r"(?:gnu )?affero general public license(?:(?: version| v)? 3(?: 0)?)?"),
    ("agpl-3", "agpl", r"(?:gnu )?agpl(?: (?:v|version )?3(?: 0)?)?(?: only| or later)?"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation license(?: version 1 [0-3])?"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? 1 1"),
    ("mpl-2", "mozilla", r"mozilla public license(?:(?: version| v)? 2(?: 0)?)?"),
    ("mpl-2", "mpl", r"mpl(?: v)? 2(?: 0)?"),
    ("epl-1", "eclipse", r"eclipse public license(?: version| v)? 1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public license(?:(?: version| v)? 2(?: 0)?)?"),
    ("cddl", "cddl", r"cddl(?: 1 [01])?"),
    ("cddl", "common", r"common development and distribution license(?: version 1 [01])?"),
    ("cpl-1", "common", r"common public license(?: version 1 0)?"),
    ("eupl", "european", r"european union public licen[cs]e(?: version)?(?: 1 [0-2])?"),
    ("eupl", "eupl", r"eupl(?: 1 [0-2])?"),
    ("artistic-2", "artistic", r"artistic license(?: version)? 2(?: 0)?"),
    ("artistic-1", "artistic", r"artistic(?: license(?: version)?(?: 1(?: 0)?)?)?"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("boost", "boost", r"boost software(?: license(?: version)?(?: 1 0)?)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: 2)?"),
    ("python", "python", r"python software foundation(?: license(?: version)?(?: 2)?)?"),
    ("php", "php", r"php(?: license(?: version)?)? 3 01"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ofl", "ofl", r"(?:sil )?ofl(?: 1 [01])?"),
    ("ofl", "font", r"(?:sil )?open font license(?: version)?(?: 1 [01])?"),
    ("odbl", "database", r"open database license(?: version)?(?: 1 0)?"),
    ("odc-by", "odc", r"odc by(?: 1 0)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("upl", "universal", r"universal permissive license(?: version)?(?: 1 0)?"),
    ("osl-3", "open", r"open software license(?: version)?(?: 3 0)?"),
    ("afl-3", "academic", r"academic free license(?: version)?(?: 3 0)?"),
    ("elastic-2", "elastic", r"elastic license(?: version)?(?: 2(?: 0)?)?"),
    ("sspl", "side", r"server side public license(?: version)?(?: 1)?"),
    ("busl", "business", r"business source license(?: version)?(?: 1 1)?"),
    ("cc0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc0", "zero", r"creative commons zero(?: 1 0)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s"),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s"),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike"),
    ("cc-by", "commons", r"creative commons attribution"),
]

#: label, words that must occur, pattern: sentences of the grant texts themselves.
GRANTS = [
    ("mit", "hereby granted", r"permission is hereby granted free of charge to any person obtaining "
                              r"a copy of this software and associated documentation files"),
    ("isc", "permission copy", r"permission to use copy modify and or distribute this software for any "
                               r"purpose with or without fee is hereby granted"),
    ("bsd-3", "redistribution neither", r"neither the name of (?:(?!neither the name of )[^ ]+ )+?"
                                        r"nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-2", "redistribution source", r"redistribution and use in source and binary forms with or "
                                       r"without modification are permitted provided"),
    ("bsd-4", "advertising acknowledgement", r"all advertising materials mentioning features or use of "
                                             r"this software must display the following acknowledgement"),
    ("apache-2", "apache licensed", r"licensed under the apache license version 2 0 the license you may "
                                    r"not use this file except in compliance with the license"),
    ("gpl", "redistribute foundation", r"you can redistribute it and or modify it under the terms of the "
                                       r"gnu general public license as published by the free software "
                                       r"foundation"),
    ("lgpl", "redistribute lesser", r"you can redistribute it and or modify it under the terms of the gnu "
                                    r"lesser general public license as published"),
    ("agpl-3", "redistribute affero", r"you can redistribute it and or modify it under the terms of the "
                                      r"gnu affero general public license as published"),
    ("mpl-2", "mozilla source", r"this source code form is subject to the terms of the mozilla public "
                                r"license v 2 0"),
    ("zlib", "warranty origin", r"the origin of this software must not be misrepresented you must not "
                                r"claim that you wrote the original software"),
    ("unlicense", "unencumbered domain", r"this is free and unencumbered software released into the "
                                         r"public domain"),
    ("boost", "hereby boost", r"boost software license version 1 0 (?:august 17th 2003 )?permission is "
                              r"hereby granted"),
    ("gfdl", "documentation permission", r"permission is granted to copy distribute and or modify this "
                                         r"document under the terms of the gnu free documentation license"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license"),
    ("public-domain", "domain dedicated", r"dedicated to the public domain"),
    ("public-domain", "domain placed", r"placed in(?:to)? the public domain"),
    ("public-domain", "domain released", r"released in(?:to)? the public domain"),
    ("proprietary", "rights reserved", r"all rights reserved"),
    ("proprietary", "proprietary confidential", r"proprietary and confidential"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this file"),
    ("terms", "terms service", r"subject to (?:the|our) terms of service"),
]

#: priority, score, words that must occur besides the family's, what stands around the name.
FORMS = [
    (1, 0.95, "spdx", r"spdx license identifier {}"),
    (2, 0.85, "licensed", r"(?:dual )?licensed under(?: the)?(?: terms of)?(?: the)? {}(?: licen[cs]e)?"),
    (2, 0.85, "under", r"(?:released|distributed|published|available|provided|made available) under"
                       r"(?: the)?(?: terms of)?(?: the)? {}(?: licen[cs]e)?"),
    (3, 0.6, "under", r"under(?: the)?(?: terms of)?(?: the)? {}(?: licen[cs]e)?"),
    (3, 0.5, "license", r"{} license"),
    (3, 0.5, "licence", r"{} licence"),
]


@dataclass(frozen=True)
class Rule:
    """Rules are tried in order; a lower priority number is better."""
    label: str
    priority: int
    score: float
    needs: frozenset
    pattern: re.Pattern


def _rule(label: str, priority: int, score: float, needs: str, pattern: str) -> Rule:
    return Rule(label, priority, score, frozenset(needs.split()),
                re.compile(f"(?<= ){pattern}(?= )"))


def standard_rules() -> list[Rule]:
    """The grant texts, then every form around every family's name."""
    rules = [_rule(label, 0, 1.0, needs, pattern) for label, needs, pattern in GRANTS]
    return rules + [_rule(label, priority, score, f"{word} {needs}", form.format(f"(?:{name})"))
                    for priority, score, word, form in FORMS for label, needs, name in FAMILIES]


@dataclass(frozen=True)
class Detection:
    label: str
    priority: int
    score: float
    start: int        # first word
    end: int          # one past the last word


def suppress(found: list[Detection]) -> list[Detection]:
    """The detections whose interval isn't inside one of better priority, or inside
    a longer one (or, of equal intervals, an earlier rule's) of its own."""
    kept: list[Detection] = []
    for priority in sorted({d.priority for d in found}):
        level = [d for d in found if d.priority == priority]
        by_start = sorted(kept, key=lambda d: d.start)
        starts = [d.start for d in by_start]
        reach = np.maximum.accumulate([d.end for d in by_start]) if by_start else []
        furthest = -1
        for d in sorted(level, key=lambda d: (d.start, -d.end)):
            at = bisect_right(starts, d.start)
            if d.end > furthest and not (at and reach[at - 1] >= d.end):
                kept.append(d)
            furthest = max(furthest, d.end)
    return sorted(kept, key=lambda d: (d.start, d.end))


def scan_text(text: str | None, rules: list[Rule], watched: frozenset) -> dict:
    """All that SCANNED names, for one text."""
    words = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower()
                         .decode("utf-8", "surrogatepass"))
    out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None,
           "base_labels": [], "labels": [], "score": 0.0, "detections": []}
    present = watched.intersection(words)
    if not present:
        return out
    joined = " " + " ".join(words) + " "
    edges = np.cumsum([1] + [len(w) + 1 for w in words])       # where each word starts
    base, base_labels = [], set()
    for phrase, label in BASE_PHRASES.items():
        at = joined.find(f" {phrase} ")
        while at >= 0:
            base.append(at + 1)
            base_labels.add(label)
            at = joined.find(f" {phrase} ", at + 1)
    found = []
    for rule in rules:
        if rule.needs <= present:
            for m in rule.pattern.finditer(joined):
                a, b = np.searchsorted(edges, [m.start(), m.end() + 1])
                found.append(Detection(rule.label, rule.priority, rule.score, int(a), int(b)))
    kept = suppress(found)
    if base:
        first, last = np.searchsorted(edges, [min(base), max(base)])
        out |= {"n_base": len(base), "first_word": int(first), "last_word": int(last)}
    out["base_labels"] = sorted(base_labels)
    out["labels"] = sorted(base_labels | {d.label for d in kept})
    out["score"] = max([d.score for d in kept] + [0.9] * bool(base), default=0.0)
    out["detections"] = [{"label": d.label, "score": d.score, "first_word": d.start,
                          "last_word": d.end - 1} for d in kept]
    return out


SCANNED = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,"
           "base_labels:array<string>,labels:array<string>,score:double,"
           "detections:array<struct<label:string,score:double,first_word:bigint,last_word:bigint>>>")
_ARROW = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
    ("last_word", pa.int64()), ("base_labels", pa.list_(pa.string())),
    ("labels", pa.list_(pa.string())), ("score", pa.float64()),
    ("detections", pa.list_(pa.struct([("label", pa.string()), ("score", pa.float64()),
                                       ("first_word", pa.int64()), ("last_word", pa.int64())])))])


def scan(docs: DataFrame, text_col: str = "text", scanned_col: str = "scanned") -> DataFrame:
    """``docs`` with a struct column ``scanned_col``: counts, base places, labels
    (base and method, distinct and sorted), score and the kept detections.

    Null and empty texts have no words, no labels and score 0; equal rows get
    equal results; an empty table stays empty.
    """
    schema = T.StructType([*docs.schema.fields,
                           T.StructField(scanned_col, T._parse_datatype_string(SCANNED))])

    def run(batches):
        rules = standard_rules()
        watched = frozenset().union(*(r.needs for r in rules),
                                    *(p.split() for p in BASE_PHRASES))
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col))
            made = pa.array([scan_text(t.as_py(), rules, watched) for t in texts], type=_ARROW)
            yield pa.RecordBatch.from_arrays([*batch.columns, made],
                                             names=[*batch.schema.names, scanned_col])

    return docs.mapInArrow(run, schema)
