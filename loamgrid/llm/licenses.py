"""License scans: fuzzy search for short notices.

Texts become lower-cased words joined by one space. A notice of n characters may differ in k = n / ERROR_CHARS edits, so
of its k + 1 parts at least one occurs unchanged: one Aho-Corasick pass finds all parts, each hit places a window, and
the regex library's bounded-error matching verifies the edits there. A notice's label is added if it is found.
Three base phrases are found word for word.

Null text is empty; repeated rows give repeated results; an empty table gives an empty result; a text of any length is scanned whole, in time that
follows its length and hits; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from loamgrid.llm.common import map_texts, read_documents

#: Label by phrase, found exactly.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Short notices of public licenses by label, found with errors (fixed values).
NOTICES = {
    "agpl": ("gnu affero general public license", "licensed under the affero gpl version 3", "if your software can interact with users remotely through a computer network"),
    "apache": ("licensed under the apache license version 2 0", "apache software license version", "distributed on an as is basis without warranties or conditions of any kind", "you may not use this file except in compliance with the license"),
    "artistic": ("licensed under the artistic license 2 0", "same terms as perl itself", "perl artistic license version"),
    "bsd": (
        "redistribution and use in source and binary forms with or without modification are permitted", "released under the bsd license", "redistributions of source code must retain the above copyright notice",
        "redistributions in binary form must reproduce the above copyright notice", "licensed under the 3 clause bsd license", "licensed under the bsd 2 clause license",
        "neither the name of the copyright holder nor the names of its contributors may be used",
    ),
    "boost": ("distributed under the boost software license version 1 0", "boost software license version 1 0"),
    "cc-by": ("creative commons attribution license", "creative commons attribution 4 0 international", "licensed under a creative commons attribution 3 0 unported license", "creativecommons org licenses by 4 0"),
    "cc-by-nc": ("licensed under cc by nc 4 0", "creative commons attribution noncommercial", "creativecommons org licenses by nc 4 0"),
    "cc-by-nc-nd": ("creative commons attribution noncommercial noderivatives", "creativecommons org licenses by nc nd"),
    "cc-by-nc-sa": ("creative commons attribution noncommercial sharealike", "creativecommons org licenses by nc sa"),
    "cc-by-nd": ("creative commons attribution noderivatives", "creativecommons org licenses by nd"),
    "cc-by-sa": ("creative commons attribution sharealike", "text is available under the creative commons attribution share alike license", "creativecommons org licenses by sa"),
    "cc0": ("cc0 1 0 universal public domain dedication", "creativecommons org publicdomain zero 1 0", "has waived all copyright and related or neighboring rights"),
    "cddl": ("common development and distribution license", "subject to the terms of the cddl version 1 0"),
    "epl": ("made available under the terms of the eclipse public license", "eclipse public license version 2 0"),
    "eupl": ("licensed under the european union public licence", "european union public license version 1 2"),
    "gfdl": ("gnu free documentation license", "permission is granted to copy distribute and or modify this document"),
    "gpl": ("licensed under the gnu general public license", "free software foundation either version", "this program is free software you can redistribute it and or modify", "without even the implied warranty of merchantability or fitness for a particular purpose"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose", "released under the isc license"),
    "lgpl": ("gnu lesser general public license", "gnu library general public license", "released under the lgpl version 2 1 or later"),
    "mit": (
        "released under the mit license", "licensed under the mit license", "permission is hereby granted free of charge to any person obtaining a copy", "the software is provided as is without warranty of any kind",
        "the above copyright notice and this permission notice shall be included in all copies", "distributed under the terms of the mit license",
    ),
    "mpl": ("subject to the terms of the mozilla public license", "mozilla public license version 2 0", "if a copy of the mpl was not distributed with this file"),
    "ms-pl": ("licensed under the microsoft public license", "microsoft public license ms pl"),
    "odbl": ("open data commons open database license", "made available under the open database license", "opendatacommons org licenses odbl"),
    "ofl": ("licensed under the sil open font license version 1 1", "reserved font name this font software is licensed"),
    "ogl": ("licensed under the open government licence", "contains public sector information licensed under"),
    "pddl": ("open data commons public domain dedication and license",),
    "postgresql": ("released under the postgresql license",),
    "psf": ("python software foundation license version 2", "licensed under the psf license agreement"),
    "public-domain": ("released into the public domain", "dedicated to the public domain", "this work is in the public domain"),
    "reserved": ("all rights reserved", "no part of this publication may be reproduced", "unauthorized copying of this file via any medium is strictly prohibited"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "unlicense org"),
    "wtfpl": ("do what the fuck you want to public license",),
    "zlib": ("altered source versions must be plainly marked as such", "released under the zlib license", "the origin of this software must not be misrepresented"),
}
ERROR_CHARS = 15
#: Lower-cases A-Z and turns every ASCII byte that is no word character into a space.
WORDS = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS).split()


@lru_cache(maxsize=1)
def _search():
    """The automaton of all parts and, per notice, label, length, allowed edits and verifying pattern."""
    notices, automaton, parts = [], ahocorasick.Automaton(), {}
    for label, texts in NOTICES.items():
        for text in texts:
            k = max(1, len(text) // ERROR_CHARS)
            cuts = [round(i * len(text) / (k + 1)) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                parts.setdefault(text[a:b], []).append((len(notices), a))
            notices.append((label, len(text), k, regex.compile(rf"(?b)(?:{regex.escape(text)}){{e<={k}}}")))
    for part, uses in parts.items():
        automaton.add_word(part, (len(part), uses))
    automaton.make_automaton()
    return automaton, notices


def fuzzy_notices(body: str) -> list[tuple[str, int, int, int, float]]:
    """``(label, start, end, edits, similarity)`` of each notice found in a normalised text; of overlapping finds the most similar, then the longest.

    Every hit of a part has a window of its own, as long as the notice with its edits on both sides, so a window holds one notice and the work follows the hits.
    """
    automaton, notices = _search()
    windows = set()
    for end, (size, uses) in automaton.iter(body):
        for i, offset in uses:
            _, length, k, _ = notices[i]
            a = end + 1 - size - offset
            windows.add((i, max(0, a - k), min(len(body), a + length + k)))
    found = set()
    for i, a, b in windows:
        label, length, _, pattern = notices[i]
        if m := pattern.search(body, a, b):
            found.add((label, m.start(), m.end(), sum(m.fuzzy_counts), 1 - sum(m.fuzzy_counts) / length))
    best: list[tuple[str, int, int, int, float]] = []  # disjoint, by start
    for f in sorted(found, key=lambda x: (-x[4], x[1] - x[2], x[1], x[0])):
        at = bisect_right(best, f[1], key=lambda x: x[1])
        if (at == 0 or best[at - 1][2] <= f[1]) and (at == len(best) or best[at][1] >= f[2]):
            best.insert(at, f)
    return best


def base_places(words: list[bytes], body: bytes) -> list[tuple[int, str]]:
    """``(index of the first word, label)`` of every place of a base phrase."""
    padded, out = b" " + body + b" ", []
    starts = None
    for phrase, label in BASE.items():
        needle = f" {phrase} ".encode()
        at = padded.find(needle)
        while at >= 0:
            if starts is None:
                starts, pos = [], 0
                for w in words:
                    starts.append(pos)
                    pos += len(w) + 1
            out.append((bisect_right(starts, at) - 1, label))
            at = padded.find(needle, at + 1)
    return sorted(out)


def scan_text(text: str | None) -> dict:
    words = words_of(text)
    body = b" ".join(words)
    base = base_places(words, body)
    fuzzy = fuzzy_notices(body.decode("utf-8", "surrogatepass"))
    base_labels = {label for _, label in base}
    return {
        "n_words": len(words),
        "n_base": len(base),
        "first_word": base[0][0] if base else None,
        "last_word": base[-1][0] if base else None,
        "base_labels": ",".join(sorted(base_labels)),
        "labels": ",".join(sorted(base_labels | {f[0] for f in fuzzy})),
        "score": 1.0 if base else max((f[4] for f in fuzzy), default=0.0),
        "notices": [dict(zip(("label", "start", "end", "edits", "similarity"), f, strict=True)) for f in fuzzy],
    }


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts, places and labels, and ``notices``, the verified spans in the normalised text."""

    span = pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32()), ("similarity", pa.float64())])
    columns = [
        *[(c, "long", pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")],
        *[(c, "string", pa.string()) for c in ("base_labels", "labels")],
        ("score", "double", pa.float64()),
        ("notices", "array<struct<label:string,start:int,end:int,edits:int,similarity:double>>", pa.list_(span)),
    ]

    def run(texts: list[str | None]):
        found = [scan_text(t) for t in texts]
        return None, [[f[c[0]] for f in found] for c in columns]

    return map_texts(docs, id_col, text_col, columns, run, id_col)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_documents(spark, sf_dir)).drop("notices")
