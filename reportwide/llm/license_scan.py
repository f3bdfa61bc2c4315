"""License scans by ordered signature rules.

A text is reduced to its lower-case words, one space between. Base phrases are looked up first.
Then the rules, a regular expression each: for every license family the names it goes by, its SPDX
identifiers and its versions, in each of the ways of stating a license; and hand-written signatures
of license bodies, notices, addresses and joined spellings ("gplv3"). A rule only runs
if one of its keywords is in the text (one Aho-Corasick pass finds them all). Detections
are taken in the order of priority, then length, then position; one whose interval lies inside
an accepted detection is suppressed, so "gnu lesser general public license version 2 1" is lgpl
and not gpl as well. Labels are those of accepted detections and of the base phrases.

All work is within a row, in one narrow pass.

Defined cases: a null or empty text has no words, no labels and score 0; rows with equal or null
doc_id are scanned one by one; extra columns are left out.
"""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from reportwide.llm.words import ALNUM_TABLE

# Base phrases and their labels.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"),
        ("cc by", "cc-by"), ("mit license", "mit"))

# (label, keywords: every spelling of every name and identifier holds one, names as regexes, SPDX identifier as words, versions)
FAMILIES = (
    ("gpl", ("gpl", "gnu"), (r"gnu general public licen[cs]e", r"gnu gpl", r"gpl"), r"gpl", r"[123]( 0)?"),
    ("lgpl", ("lgpl", "gnu"), (r"gnu (lesser|library) general public licen[cs]e", r"gnu lgpl", r"lgpl"), r"lgpl", r"[23]( [01])?"),
    ("agpl", ("agpl", "affero"), (r"gnu affero general public licen[cs]e", r"affero gpl", r"agpl"), r"agpl", r"[13]( 0)?"),
    ("gfdl", ("gfdl", "gnu"), (r"gnu free documentation licen[cs]e", r"gfdl"), r"gfdl", r"1 [123]"),
    ("apache", ("apache",), (r"apache software licen[cs]e", r"apache licen[cs]e", r"apache"), r"apache", r"[12]( [01])?"),
    ("mit", ("mit",), (r"mit licen[cs]e", r"mit x11 licen[cs]e", r"mit"), r"mit", r"0"),
    ("bsd", ("bsd",), (r"(new |modified |simplified )?bsd licen[cs]e", r"bsd", r"(two|three|four|[0234]) clause bsd( licen[cs]e)?"), r"bsd", r"[0234] clause"),
    ("isc", ("isc", "consortium"), (r"isc licen[cs]e", r"internet systems consortium licen[cs]e"), r"isc", r"1"),
    ("mpl", ("mpl", "mozilla"), (r"mozilla public licen[cs]e", r"mpl"), r"mpl", r"[12] [01]"),
    ("epl", ("epl", "eclipse"), (r"eclipse public licen[cs]e", r"epl"), r"epl", r"[12] 0"),
    ("edl", ("edl", "eclipse"), (r"eclipse distribution licen[cs]e", r"edl"), r"edl", r"1 0"),
    ("cddl", ("cddl", "license", "licence"), (r"common development and distribution licen[cs]e", r"cddl"), r"cddl", r"1 [01]"),
    ("cpl", ("cpl", "license", "licence"), (r"common public licen[cs]e", r"cpl"), r"cpl", r"1 0"),
    ("eupl", ("eupl", "license", "licence"), (r"european union public licen[cs]e", r"eupl"), r"eupl", r"1 [012]"),
    ("artistic", ("artistic",), (r"(perl )?artistic licen[cs]e", r"clarified artistic licen[cs]e"), r"artistic", r"[12] 0"),
    ("zlib", ("zlib", "libpng"), (r"zlib licen[cs]e", r"zlib libpng licen[cs]e"), r"zlib", r"1"),
    ("boost", ("boost", "bsl"), (r"boost software licen[cs]e", r"bsl"), r"bsl", r"1 0"),
    ("unlicense", ("unlicense", "unlicence"), (r"the unlicen[cs]e", r"unlicen[cs]e"), r"unlicense", r"1"),
    ("wtfpl", ("wtfpl", "license", "licence"), (r"do what the f\w+ you want to public licen[cs]e", r"wtfpl"), r"wtfpl", r"[12]( 0)?"),
    ("cc0", ("cc0", "zero"), (r"creative commons zero", r"cc0"), r"cc0", r"1 0"),
    ("cc-by", ("cc", "creative"), (r"creative commons attribution( \d 0)?( international)?( licen[cs]e)?", r"cc by"), r"cc by", r"[1234] [05]"),
    ("cc-by-sa", ("cc", "creative"), (r"creative commons attribution share ?alike( licen[cs]e)?", r"cc by sa"), r"cc by sa", r"[1234] [05]"),
    ("cc-by-nc", ("cc", "creative"), (r"creative commons attribution non ?commercial( licen[cs]e)?", r"cc by nc"), r"cc by nc", r"[1234] [05]"),
    ("cc-by-nd", ("cc", "creative"), (r"creative commons attribution no ?deriv(ative)?s( licen[cs]e)?", r"cc by nd"), r"cc by nd", r"[1234] [05]"),
    ("cc-by-nc-sa", ("cc", "creative"), (r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa"), r"cc by nc sa", r"[1234] [05]"),
    ("cc-by-nc-nd", ("cc", "creative"), (r"creative commons attribution non ?commercial no ?deriv(ative)?s", r"cc by nc nd"), r"cc by nc nd", r"[1234] [05]"),
    ("ofl", ("ofl", "font"), (r"sil open font licen[cs]e", r"open font licen[cs]e", r"ofl"), r"ofl", r"1 [01]"),
    ("odbl", ("odbl", "license", "licence"), (r"open database licen[cs]e", r"odbl"), r"odbl", r"1 0"),
    ("odc-by", ("odc", "commons"), (r"open data commons attribution licen[cs]e", r"odc by"), r"odc by", r"1 0"),
    ("pddl", ("pddl", "dedication"), (r"public domain dedication and licen[cs]e", r"pddl"), r"pddl", r"1 0"),
    ("psf", ("psf", "python"), (r"python software foundation licen[cs]e", r"psf licen[cs]e"), r"psf", r"2( 0)?"),
    ("ruby", ("ruby",), (r"ruby licen[cs]e",), r"ruby", r"1"),
    ("php", ("php",), (r"php licen[cs]e",), r"php", r"3 0[01]?"),
    ("openssl", ("openssl", "ssleay"), (r"openssl licen[cs]e", r"ssleay licen[cs]e"), r"openssl", r"1"),
    ("postgresql", ("postgresql",), (r"postgresql licen[cs]e",), r"postgresql", r"1"),
    ("afl", ("afl", "academic"), (r"academic free licen[cs]e", r"afl"), r"afl", r"[123] [012]"),
    ("osl", ("osl", "license", "licence"), (r"open software licen[cs]e", r"osl"), r"osl", r"[123] [01]"),
    ("ms-pl", ("microsoft", "ms"), (r"microsoft public licen[cs]e", r"ms pl"), r"ms pl", r"1"),
    ("ms-rl", ("microsoft", "ms"), (r"microsoft reciprocal licen[cs]e", r"ms rl"), r"ms rl", r"1"),
    ("upl", ("upl", "permissive"), (r"universal permissive licen[cs]e", r"upl"), r"upl", r"1 0"),
    ("bsl-business", ("busl", "license", "licence"), (r"business source licen[cs]e", r"busl"), r"busl", r"1 [01]"),
    ("sspl", ("sspl", "license", "licence"), (r"server side public licen[cs]e", r"sspl"), r"sspl", r"1( 0)?"),
)

# (name, priority, score, pattern with the family's name, identifier and version in place)
STATEMENTS = (
    ("identifier", 100, 1.0, r"spdx license identifier {spdx}( v?{version})?( (only|or later))?"),
    ("grant", 90, 0.95, r"(re)?(licen[cs]ed|leased|distributed|published|available|used|provided) under (the )?(terms of )?(the )?{name}( \(?v(ersion )?{version})?"),
    ("versioned", 80, 0.9, r"{name}( licen[cs]e)? (v|version |v )?{version}( or( \(at your option\))? (any )?later( version)?)?"),
    ("later", 75, 0.85, r"either version {version} of the {name}"),
    ("terms", 70, 0.8, r"(terms|conditions|copy|text) of the {name}"),
    ("permission", 65, 0.8, r"permission is hereby granted free of charge (\w+ ){{0,12}}{name}"),
    ("named", 60, 0.7, r"{name}"),
)
# A bare name counts only where it is spelled out or says that it is a license.
_SPELLED = re.compile(r"licen|commons|^cc |creative")


# Hand-written signatures of license bodies, notices, addresses and joined spellings:
# (label, keyword that every match holds (several: any of them), score, pattern).
SIGNATURES = (
    ("mit", "obtaining", 0.95, r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "portions", 0.85, r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "consortium", 0.85, r"except as contained in this notice the name of the x consortium shall not be used"),
    ("json", "evil", 0.9, r"the software shall be used for good not evil"),
    ("isc", "fee", 0.95, r"permission to use copy modify (and or|and|or) distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "fee", 0.9, r"permission to use copy modify (and or|and|or) distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("ntp", "fee", 0.9, r"permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted"),
    ("postgresql", "fee", 0.9, r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd", "redistribution", 0.95, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", 0.9, r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "redistributions", 0.9, r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer"),
    ("bsd", "endorse", 0.9, r"neither the name of (\w+ ){1,12}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd", "acknowledgement", 0.85, r"all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", ("regents", "contributors"), 0.85, r"this software is provided by the (regents|copyright holders) and contributors as is and any express or implied warranties"),
    ("gpl", "gnu", 0.95, r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "gnu", 0.9, r"you should have received a copy of the gnu general public license along with"),
    ("gpl", "gnu", 0.9, r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", "gnu", 0.9, r"by contrast the gnu general public license is intended to guarantee your freedom to share and change"),
    ("lgpl", "gnu", 0.95, r"this (library|program) is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license"),
    ("lgpl", "gnu", 0.9, r"you should have received a copy of the gnu (lesser|library) general public license along with"),
    ("lgpl", "gnu", 0.9, r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("agpl", "affero", 0.95, r"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "affero", 0.9, r"you should have received a copy of the gnu affero general public license along with"),
    ("agpl", "affero", 0.9, r"the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", "gnu", 0.95, r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache", "apache", 0.95, r"you may not use this file except in compliance with the license you may obtain a copy of the license at https? www apache org licenses license 2 0"),
    ("apache", "apache", 0.85, r"www apache org licenses"),
    ("mpl", "mozilla", 0.95, r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", "mpl", 0.9, r"if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "mozilla", 0.9, r"the contents of this file are subject to the mozilla public license version 1 [01]"),
    ("epl", "eclipse", 0.95, r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "eclipse", 0.9, r"the accompanying program is provided under the terms of this eclipse public license"),
    ("edl", "eclipse", 0.9, r"made available under the terms of the eclipse distribution license"),
    ("cddl", "development", 0.95, r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl", "agreement", 0.9, r"the accompanying program is provided under the terms of this common public license agreement"),
    ("zlib", "damages", 0.95, r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("zlib", "misrepresented", 0.9, r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", "misrepresented", 0.9, r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("boost", "organization", 0.95, r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", "unencumbered", 0.95, r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "binary", 0.9, r"anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary"),
    ("wtfpl", "do", 0.9, r"you just do what the f\w+ you want to"),
    ("cc0", "deed", 0.9, r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", "publicdomain", 0.9, r"creativecommons org publicdomain zero"),
    ("cc0", "jurisdictions", 0.9, r"the laws of most jurisdictions throughout the world automatically confer exclusive copyright and related rights"),
    ("cc-by", "creativecommons", 0.9, r"creativecommons org licenses by [1234] [05]"),
    ("cc-by-sa", "creativecommons", 0.9, r"creativecommons org licenses by sa( [1234] [05])?"),
    ("cc-by-nc", "creativecommons", 0.9, r"creativecommons org licenses by nc [1234] [05]"),
    ("cc-by-nd", "creativecommons", 0.9, r"creativecommons org licenses by nd( [1234] [05])?"),
    ("cc-by-nc-sa", "creativecommons", 0.9, r"creativecommons org licenses by nc sa( [1234] [05])?"),
    ("cc-by-nc-nd", "creativecommons", 0.9, r"creativecommons org licenses by nc nd( [1234] [05])?"),
    ("cc-by", "commons", 0.85, r"exercising the licensed rights you accept and agree to be bound by the terms and conditions of this creative commons attribution (\d 0 )?international public license"),
    ("ofl", "font", 0.95, r"this font software is licensed under the sil open font license"),
    ("ofl", "font", 0.9, r"permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("artistic", "package", 0.9, r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "artistic", 0.9, r"you can redistribute it and or modify it under the terms of the artistic license"),
    ("perl", "perl", 0.9, r"you can redistribute it and or modify it under the same terms as perl itself"),
    ("psf", "python", 0.95, r"this license agreement is between the python software foundation"),
    ("openssl", "openssl", 0.9, r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("openssl", "cryptographic", 0.9, r"this product includes cryptographic software written by eric young"),
    ("php", "php", 0.9, r"this product includes php software freely available from"),
    ("odbl", "odbl", 0.9, r"the open database license odbl is a license agreement intended to allow users to freely share modify and use this database"),
    ("eupl", "eupl", 0.9, r"this european union public licence the eupl applies to the work"),
    ("ms-pl", "governs", 0.85, r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("bsl-business", "licensor", 0.95, r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work"),
    ("sspl", "service", 0.9, r"available to third parties as a service you must make the service source code available"),
    ("upl", "larger", 0.9, r"any piece of software and or hardware listed in the larger works"),
    ("ncsa", "ncsa", 0.9, r"university of illinois ncsa open source license"),
    ("ncsa", "ncsa", 0.85, r"ncsa licen[cs]e"),
    ("beerware", "beer", 0.9, r"the beer ware license"),
    ("beerware", "beerware", 0.85, r"beerware"),
    ("cecill", ("cecill", "cecillb", "cecillc"), 0.85, r"cecill[bc]?( [bc])?"),
    ("vim", "vim", 0.85, r"vim licen[cs]e"),
    ("curl", "curl", 0.85, r"curl licen[cs]e"),
    ("libtiff", "libtiff", 0.85, r"libtiff licen[cs]e"),
    ("x11", "x11", 0.85, r"x11 licen[cs]e"),
    ("python", "python", 0.8, r"same (license|terms) as python"),
    ("public-domain", "domain", 0.8, r"(released|placed|dedicated) (in|into|to) the public domain"),
    ("public-domain", "domain", 0.8, r"this (file|code|work|software) is in the public domain"),
    ("proprietary", "unauthorized", 0.9, r"unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "confidential", 0.85, r"proprietary and confidential"),
    ("gpl", ("gplv1", "gplv2", "gplv3", "gpl1", "gpl2", "gpl3"), 0.85, r"gplv?[123]( [01])?"),
    ("lgpl", ("lgplv2", "lgplv3", "lgpl2", "lgpl3"), 0.85, r"lgplv?[23]( [01])?"),
    ("agpl", ("agplv1", "agplv3", "agpl1", "agpl3"), 0.85, r"agplv?[13]( 0)?"),
    ("gfdl", ("gfdlv1", "gfdl1"), 0.85, r"gfdlv?1( [123])?"),
    ("apache", ("apachev2", "apache2"), 0.85, r"apachev?2( 0)?"),
    ("asl", ("asl2", "aslv2"), 0.8, r"aslv?2( 0)?"),
    ("mpl", ("mplv1", "mplv2", "mpl1", "mpl2"), 0.85, r"mplv?[12]( [01])?"),
    ("epl", ("eplv1", "eplv2", "epl1", "epl2"), 0.85, r"eplv?[12]( 0)?"),
    ("bsd", ("bsd2", "bsd3", "bsd4"), 0.85, r"bsd[234]( clause)?"),
    ("cddl", ("cddlv1", "cddl1"), 0.85, r"cddlv?1( [01])?"),
    ("osl", ("oslv3", "osl3"), 0.85, r"oslv?3( 0)?"),
    ("eupl", ("euplv1", "eupl1"), 0.85, r"euplv?1( [012])?"),
    ("wtfpl", ("wtfplv2", "wtfpl2"), 0.85, r"wtfplv?2"),
    ("cc0", ("cc01", "cc0v1"), 0.8, r"cc0v?1( 0)?"),
    ("gpl", "gpl", 0.8, r"gpl licen[cs]e"),
    ("lgpl", "lgpl", 0.8, r"lgpl licen[cs]e"),
    ("agpl", "agpl", 0.8, r"agpl licen[cs]e"),
    ("apache", "apache", 0.8, r"apache 2( 0)? licen[cs]e"),
    ("mpl", "mpl", 0.8, r"mpl licen[cs]e"),
    ("epl", "epl", 0.8, r"epl licen[cs]e"),
)
# Signatures stand between identifiers and other statements.
SIGNATURE = 95


def _whole_words(pattern: str) -> re.Pattern:
    return re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())


@cache
def rules() -> tuple:
    """(priority, score, label, keywords, regex) of every rule, the most specific first."""
    out = []
    for label, keywords, names, spdx, version in FAMILIES:
        for statement, priority, score, pattern in STATEMENTS:
            spelled = [n for n in names if _SPELLED.search(n)] if statement in ("named", "terms") else names
            if not spelled and "{name}" in pattern:
                continue
            text = pattern.format(name=f"(?:{'|'.join(spelled)})", spdx=spdx, version=version)
            out.append((priority, score, label, frozenset(keywords), _whole_words(text)))
    for label, keywords, score, pattern in SIGNATURES:
        keywords = (keywords,) if isinstance(keywords, str) else keywords
        out.append((SIGNATURE, score, label, frozenset(keywords), _whole_words(pattern)))
    return tuple(sorted(out, key=lambda r: (-r[0], r[2])))


# The keywords of all families, which the keyword pass looks for; nothing else gates a rule.
GATE = tuple(sorted({f" {k} ".encode() for r in rules() for k in r[3]}))


@cache
def _automaton():
    import ahocorasick
    a = ahocorasick.Automaton()
    for g in GATE:
        a.add_word(g.decode(), g.decode().strip())
    a.make_automaton()
    return a


def detections(joined: bytes) -> list[tuple[int, int, str, float]]:
    """Accepted (start, end, label, score) in a text of single-spaced lower-case words."""
    padded = f" {joined.decode('latin-1')} "
    found = {word for _, word in _automaton().iter(padded)}
    if not found:
        return []
    raw = []
    for priority, score, label, keywords, regex in rules():
        if keywords & found:
            raw += [(-priority, m.start() - m.end(), m.start(), m.end(), label, score) for m in regex.finditer(joined)]
    return _not_inside(sorted(raw))


def _not_inside(raw: list[tuple]) -> list[tuple[int, int, str, float]]:
    """Detections that lie inside no earlier one, by one sweep for each priority.

    What lies inside a suppressed detection lies inside the one that suppressed it, so a detection is
    compared with all of the same or a higher priority: by start, longer ones first, those before it
    begin no later, and one of them holds it if the furthest of their ends is not before its own.
    """
    if not raw:
        return []
    rank = np.arange(len(raw))
    tier, start, end = (np.array([r[k] for r in raw]) for k in (0, 2, 3))
    order = np.lexsort((rank, -end, start))
    kept = np.zeros(len(raw), np.bool_)
    for t in np.unique(tier):
        at = order[tier[order] <= t]
        reach = np.concatenate([[-1], np.maximum.accumulate(end[at])[:-1]])
        kept[at] |= (tier[at] == t) & (reach < end[at])
    return sorted(r[2:] for r, k in zip(raw, kept.tolist()) if k)


def scan_text(text: bytes):
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, detections) of one text."""
    words = text.translate(ALNUM_TABLE).split()
    joined = b" ".join(words)
    padded = b" " + joined + b" "
    places, base = [], set()
    for phrase, label in BASE:
        p = f" {phrase} ".encode()
        at, counted, word = padded.find(p), 0, 0
        while at >= 0:
            word += padded.count(b" ", counted, at)
            counted = at
            places.append(word)
            base.add(label)
            at = padded.find(p, at + 1)
    hits = detections(joined)
    labels = base | {h[2] for h in hits}
    score = max([0.6 if base else 0.0, *(h[3] for h in hits)])
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, hits)


def _scan(batches):
    for b in batches:
        rows = [scan_text(v.as_buffer().to_pybytes() if v.is_valid else b"") for v in b.column("text")]
        cols = list(zip(*rows)) if rows else [()] * 8
        spans = [[{"start": a, "end": z, "label": x, "score": s} for a, z, x, s in r] for r in cols[7]]
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("score", pa.float64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds)), pa.array(spans, span)],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document row; spans are byte intervals in its single-spaced lower-case words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _scan, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, "
               "labels string, score double, spans array<struct<start:long,end:long,label:string,score:double>>")
