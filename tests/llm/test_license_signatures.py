"""License bodies, joined spellings, and suppression against brute force."""

from __future__ import annotations

import os
import sys
import time

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reportwide.llm import license_scan as L  # noqa: E402

BODIES = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear", "isc"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation", "gpl"),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License", "lgpl"),
    ("You should have received a copy of the GNU Affero General Public License along with this program.", "agpl"),
    ("you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0", "apache"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("3. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.", "zlib"),
    ("Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "boost"),
    ("This Font Software is licensed under the SIL Open Font License, Version 1.1.", "ofl"),
    ("https://creativecommons.org/licenses/by-sa/4.0/", "cc-by-sa"),
    ("GPLv2", "gpl"), ("GPLv3+", "gpl"), ("LGPLv2.1", "lgpl"), ("Apache2", "apache"), ("the gpl license", "gpl"), ("BSD3", "bsd")]


@pytest.mark.parametrize("text,labels", BODIES)
def test_bodies_and_joined_spellings(text, labels):
    got = L.scan_text(f"Some words before.\n\n{text}\n\nand after".encode())
    assert got[5] == labels and 0 < got[6] <= 1


@pytest.mark.parametrize("text", ["permission is hereby granted to leave early", "redistribution of wealth", "the mit students", "a font of wisdom",
                                  "distributed in the hope that it helps", "in the domain of public health"])
def test_other_texts_have_no_label(text):
    assert L.scan_text(text.encode())[5] == ""


def test_every_signature_match_holds_a_keyword():
    from test_corpus_operators import spellings
    rng = np.random.default_rng(6)
    for label, keywords, _score, pattern in L.SIGNATURES:
        keywords = {keywords} if isinstance(keywords, str) else set(keywords)
        regex = L._whole_words(pattern)
        for text in spellings(pattern, rng, 60):
            m = regex.search(text.encode())
            if m:
                assert keywords & set(m[0].decode().split()), (label, text)


@pytest.mark.parametrize("seed", range(30))
def test_suppression_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    raw = sorted({(-int(rng.integers(1, 4)), a - z, a, z, "xyz"[rng.integers(3)], 0.5) for a, z in
                  ((int(a), int(a + n)) for a, n in zip(rng.integers(0, 25, 40), rng.integers(1, 9, 40)))})
    kept: list = []
    for _p, _n, a, z, label, score in raw:
        if not any(x <= a and z <= y for x, y, *_ in kept):
            kept.append((a, z, label, score))
    assert L._not_inside(raw) == sorted(kept)
    assert L._not_inside([]) == []


def test_time_is_linear_in_a_long_text():
    L.scan_text(b"mit license")
    took = []
    for n in (20_000, 80_000):  # the second one is over a megabyte
        t0 = time.perf_counter()
        r = L.scan_text(b"mit license x " * n)
        took.append(time.perf_counter() - t0)
        assert r[:4] == (3 * n, n, 0, 3 * n - 3) and len(r[6:]) and len(r[7]) == n
    assert took[1] < 8 * took[0] + 0.5
