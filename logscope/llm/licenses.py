"""Licence scans (operator 6): sentence-rule recognition.

1. A text is cut into sentences (end marks followed by white space, blank lines, lines that
   end in another mark), which are normalised: comment
   markers and quotes go, white space is single, letters are lower case, ``licence`` is spelt
   ``license``.
2. ``SENTENCES`` maps a normalised sentence to the identifier of a known licence sentence; a part in
   parentheses (a version, a name) is kept with it.  A sentence that talks of licences but is not known
   becomes ``unknown``; all others break the sequence.
3. ``RULES`` are tried in order at each place of the sequence of identifiers; the first that
   matches names the licence and uses up its sentences.  A rule's identifiers must follow each other; those marked with ``?``
   may be missing.

Every row is judged from its whole text; a scalar column, so no shuffle.  Texts without any of ``CUES`` are passed over.

Defined cases: null and empty texts have no licence; a licence that a text names twice is listed
twice in ``matches`` and once in ``licenses``; sentences known but used by no rule, and unknown ones, are
counted in ``unknown``; repeated rows are judged alike; input columns are kept and
result columns of the same name replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from .common import texts

# Sentences of public licence texts and the identifiers given to them
SENTENCES = [
    ("spdx", r"spdx-license-identifier:? ?([a-z0-9.+-]+)"),
    ("mit-grant", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("mit-notice", r"the above copyright notice and this permission notice (?:\(.*\) )?shall be included in all copies"),
    ("isc-grant", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("as-is", r"the software is provided as is,? (?:and the author disclaims all warranties|without warranty of any kind)"),
    ("no-liability", r"in no event shall the (?:authors?|copyright (?:holders?|owners?)|regents)"),
    ("bsd-grant", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd-source", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-binary", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-advert", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-endorse", r"neither the names? of .* may be used to endorse or promote products"),
    ("bsd-as-is", r"this software is provided by .* as is and any express or implied warranties"),
    ("apache-may", r"you may not use this file except in compliance with the license"),
    ("apache-copy", r"you may obtain a copy of the license at"),
    ("apache-law", r"unless required by applicable law or agreed to in writing, software"),
    ("apache-see", r"see the license for the specific language governing permissions"),
    ("gpl-terms", r"(?:redistribute it and/or modify it|is licensed) under the terms of the gnu (affero |lesser |library )?general public license"),
    ("gpl-version", r"either version ([0-9.]+) of the license, or \(at your option\) any later version"),
    ("gpl-warranty", r"(?:is distributed in the hope that it will be useful, but )?without any warranty; without even the implied warranty"),
    ("gpl-copy", r"you should have received a copy of the gnu (?:affero |lesser |library )?general public license"),
    ("mpl", r"subject to the terms of the mozilla public license,? v(?:ersion|\.) ?([0-9.]*[0-9])"),
    ("public-domain", r"free and unencumbered software released into the public domain|dedicated to the public domain"),
    ("under-apache", r"(?:licensed|released|distributed|available) under (?:the )?apache license,? v(?:ersion|\.)? ?([0-9.]*[0-9])"),
    ("under-agpl", r"(?:licensed|released|distributed|available) under (?:the )?gnu affero general public license(?:,? v(?:ersion|\.)? ?([0-9.]*[0-9]))?"),
    ("under-lgpl", r"(?:licensed|released|distributed|available) under (?:the )?gnu lesser general public license(?:,? v(?:ersion|\.)? ?([0-9.]*[0-9]))?"),
    ("under-gpl", r"(?:licensed|released|distributed|available) under (?:the )?gnu general public license(?:,? v(?:ersion|\.)? ?([0-9.]*[0-9]))?"),
    ("under-mit", r"(?:licensed|released|distributed|available) under (?:the )?mit license"),
    ("under-isc", r"(?:licensed|released|distributed|available) under (?:the )?isc license"),
    ("under-bsd", r"(?:licensed|released|distributed|available) under (?:the |a )?(?:([234])-clause )?bsd(?:-style)? license"),
    ("under-cc", r"(?:licensed|released|distributed|available) under (?:a |the )?(?:cc|creative commons) (by(?:-nc)?(?:-sa|-nd)?(?: [0-9.]*[0-9])?|0(?: [0-9.]*[0-9])?)"),
]

# Licences as sequences of sentence identifiers, in order of precedence
RULES = [
    ("Apache-{0}", "under-apache apache-may? apache-copy? apache-law? apache-see?"),
    ("Apache-2.0", "apache-may apache-copy apache-law? apache-see?"),
    ("BSD-4-Clause", "bsd-grant bsd-source bsd-binary bsd-advert bsd-endorse? bsd-as-is? no-liability?"),
    ("BSD-3-Clause", "bsd-grant bsd-source bsd-binary bsd-endorse bsd-as-is? no-liability?"),
    ("BSD-2-Clause", "bsd-grant bsd-source bsd-binary bsd-as-is? no-liability?"),
    ("MIT", "mit-grant mit-notice? as-is? no-liability?"),
    ("ISC", "isc-grant as-is? no-liability?"),
    ("AGPL-{1}-or-later", "gpl-terms=affero gpl-version gpl-warranty? gpl-copy?"),
    ("LGPL-{1}-or-later", "gpl-terms=lesser gpl-version gpl-warranty? gpl-copy?"),
    ("GPL-{1}-or-later", "gpl-terms gpl-version gpl-warranty? gpl-copy?"),
    ("GPL", "gpl-terms gpl-warranty? gpl-copy?"),
    ("AGPL-{0}", "under-agpl"),
    ("LGPL-{0}", "under-lgpl"),
    ("GPL-{0}", "under-gpl gpl-warranty? gpl-copy?"),
    ("MIT", "under-mit mit-grant? mit-notice? as-is? no-liability?"),
    ("ISC", "under-isc isc-grant? as-is? no-liability?"),
    ("BSD-{0}-Clause", "under-bsd bsd-source? bsd-binary? bsd-endorse? bsd-as-is? no-liability?"),
    ("CC-{0}", "under-cc"),
    ("MPL-{0}", "mpl"),
    ("Public-Domain", "public-domain"),
    ("{0}", "spdx"),
]

CUES = ("licen", "permission", "redistribut", "spdx", "public domain", "warrant", "in no event")
MORE_CUES = (*CUES, "endorse", "advertising materials", "liab", "as is")
_KNOWN = [(name, re.compile(pattern)) for name, pattern in SENTENCES]
_TALK = re.compile(r"\blicense[ds]?\b|\bpermission\b.*\bgranted\b|\bwarranty\b|spdx-")
_END = re.compile(r"(?<=[.!?])\s+|\n\s*\n|(?<=[^\w\s,;:(/-])[ \t]*\n")
_EDGE = re.compile(r"(?m)^[ \t]*(?:/\*+|\*+/|//+|\*+|#+|;+|--+|<!--)[ \t]?|\*/|-->")
_QUOTES = re.compile("[\"'`“”‘’«»]")


def normalise(sentence: str) -> str:
    s = _QUOTES.sub("", _EDGE.sub(" ", sentence)).lower().replace("licence", "license")
    return " ".join(s.split())


def _tokens(text: str) -> list[tuple[str, str, int, int]]:
    """(identifier, kept part, start, end) of the sentences; a break is an empty identifier."""
    out, a = [], 0
    for m in [*_END.finditer(text), None]:
        b = m.start() if m else len(text)
        raw = text[a:b]
        low = raw.lower()
        if any(c in low for c in MORE_CUES):
            s = normalise(raw)
            hit = [(name, k) for name, p in _KNOWN if (k := p.search(s))]
            at = {name: k.start() for name, k in hit}
            for name, k in sorted(hit, key=lambda x: at[x[0]]) or ([("unknown", None)] if _TALK.search(s) else []):
                kept = next((g for g in k.groups() if g), "") if k else ""
                out.append((name, kept.strip(), a, b))
        elif re.search("[a-z]{2}", low) and not re.search("copyright|rights reserved|https?://", low) and (not out or out[-1][0]):
            out.append(("", "", a, b))
        a = m.end() if m else b
    return out


def _match(rule: str, tokens: list[tuple[str, str, int, int]], i: int) -> tuple[int, list[str]] | None:
    """(place after, kept parts) if the rule matches the identifiers from ``i`` on."""
    kept: list[str] = []
    for step in rule.split():
        name, _, want = step.rstrip("?").partition("=")
        here = i < len(tokens) and tokens[i][0] == name and (not want or tokens[i][1] == want)
        if here:
            kept.append(tokens[i][1])
            i += 1
        elif not step.endswith("?"):
            return None
    return i, kept


def scan(text: str) -> tuple[list[tuple[str, int, int]], int]:
    """([(licence, start, end)], number of licence sentences that no rule used)."""
    low = text.lower()
    if not any(c in low for c in CUES):
        return [], 0
    tokens, out, unknown, i = _tokens(text), [], 0, 0
    while i < len(tokens):
        for name, rule in RULES:
            got = _match(rule, tokens, i)
            if got:
                parts = [p.upper() for p in (*got[1], "", "")]
                label = re.sub("-+", "-", name.format(*parts).replace(" ", "-")).strip("-")
                label = label.replace("-ONLY", "-only").replace("-OR-LATER", "-or-later")
                out.append((label, tokens[i][2], tokens[got[0] - 1][3]))
                i = got[0]
                break
        else:
            unknown += bool(tokens[i][0])
            i += 1
    return out, unknown


def licence_matches(text: str | Column) -> Column:
    kind = pa.struct([("matches", pa.list_(pa.struct([("license", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
                      ("unknown", pa.int32())])

    @arrow_udf("struct<matches:array<struct<license:string,start:long,end:long>>,unknown:int>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for arr in batches:
            got = [scan(t) for t in texts(arr)]
            yield pa.array([{"matches": [{"license": n, "start": a, "end": b} for n, a, b in m], "unknown": u}
                            for m, u in got], kind)

    return run(text)


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``matches`` (licence, start and end in characters of the text, in order), ``licenses`` (distinct,
    sorted) and ``unknown``."""
    from .common import fresh

    (found,) = fresh(docs, "_found")
    out = docs.withColumn(found, licence_matches(text))
    return out.withColumns({
        "matches": F.col(f"{found}.matches"), "unknown": F.col(f"{found}.unknown"),
        "licenses": F.array_sort(F.array_distinct(F.col(f"{found}.matches.license")))}).drop(found)
