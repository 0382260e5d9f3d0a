"""Signature rules for licences: families, written by hand, and the rules they stand for.

A family is one licence; its rules are regular expressions over text in lower case whose words are
separated by single spaces (punctuation kept), each with the keyword that a text must contain
for the rule to be tried, a priority and a confidence. Of overlapping finds the one with the
higher priority stands: a full notice over a licence text's first words, those over a
statement, an identifier or address, and a title.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Kinds of rules: priority and confidence.
KINDS = {"notice": (5, 1.0), "statement": (4, 0.95), "identifier": (3, 0.9), "address": (3, 0.85), "title": (2, 0.8)}


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    kind: str
    keyword: str
    pattern: str


@dataclass(frozen=True)
class Family:
    """label; keyword (a whole word of every title); titles and identifiers as patterns; addresses; notices."""

    label: str
    keyword: str
    titles: tuple[str, ...]
    identifiers: tuple[str, ...] = ()
    addresses: tuple[str, ...] = ()
    notices: tuple[tuple[str, str], ...] = ()


_V = r"(?:,? ?(?:version|v\.?) ?)"

FAMILIES = (
    Family("mit", "mit", (r"mit licen[sc]e", r"mit/x11 licen[sc]e", r"expat licen[sc]e \(mit\)"), (r"mit", r"mit-0", r"x11"),
           (r"opensource\.org/licenses?/mit", r"spdx\.org/licenses/mit"),
           (("permission", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
            ("software", r"the software is provided [\"“]?as is[\"”]?, without warranty of any kind"))),
    Family("apache", "apache", (r"apache licen[sc]e", r"apache software licen[sc]e"), (r"apache", r"asl"),
           (r"apache\.org/licenses", r"opensource\.org/licenses?/apache-2\.0"),
           (("apache", r"licensed to the apache software foundation \(asf\) under one or more contributor license agreements"),)),
    Family("apache-2.0", "apache", (rf"apache licen[sc]e{_V}2(?:\.0)?", r"apache 2\.0 licen[sc]e"), (r"apache-2\.0",),
           (r"apache\.org/licenses/license-2\.0",),
           (("apache", r"licensed under the apache license, version 2\.0 \(the [\"“]license[\"”]\)"),)),
    Family("apache-1.1", "apache", (rf"apache (?:software )?licen[sc]e{_V}1\.1",), (r"apache-1\.1",), (r"apache\.org/licenses/license-1\.1",)),
    Family("gpl", "general", (r"gnu general public licen[sc]e", r"general public licen[sc]e"), (r"gpl",), (r"gnu\.org/licenses/gpl",),
           (("free", r"this program is free software[:;] you can redistribute it and/or modify it under the terms of the gnu general public license"),
            ("warranty", r"without even the implied warranty of merchantability or fitness for a particular purpose"))),
    Family("gpl-2.0", "general", (rf"gnu general public licen[sc]e{_V}2(?:\.0)?",), (r"gpl-2\.0(?:-only|-or-later|\+)?", r"gplv2\+?"),
           (r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0",)),
    Family("gpl-3.0", "general", (rf"gnu general public licen[sc]e{_V}3(?:\.0)?",), (r"gpl-3\.0(?:-only|-or-later|\+)?", r"gplv3\+?"),
           (r"gnu\.org/licenses/gpl-3\.0",)),
    Family("lgpl", "lesser", (r"gnu lesser general public licen[sc]e", r"lesser general public licen[sc]e"), (r"lgpl",), (r"gnu\.org/licenses/lgpl",)),
    Family("lgpl-2.1", "lesser", (rf"gnu lesser general public licen[sc]e{_V}2\.1",), (r"lgpl-2\.1(?:-only|-or-later|\+)?", r"lgplv2\.1\+?"),
           (r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1",)),
    Family("lgpl-3.0", "lesser", (rf"gnu lesser general public licen[sc]e{_V}3(?:\.0)?",), (r"lgpl-3\.0(?:-only|-or-later|\+)?", r"lgplv3\+?"),
           (r"gnu\.org/licenses/lgpl-3\.0",)),
    Family("agpl-3.0", "affero", (rf"gnu affero general public licen[sc]e(?:{_V}3(?:\.0)?)?",), (r"agpl(?:-3\.0(?:-only|-or-later|\+)?)?", r"agplv3\+?"),
           (r"gnu\.org/licenses/agpl",)),
    Family("gfdl", "documentation", (r"gnu free documentation licen[sc]e",), (r"gfdl(?:-1\.[1-3])?",), (r"gnu\.org/licenses/fdl",),
           (("permission", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),)),
    Family("bsd", "bsd", (r"bsd licen[sc]e", r"bsd-style licen[sc]e"), (r"bsd",), (r"opensource\.org/licenses?/bsd",),
           (("redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted"),
            ("redistributions", r"redistributions of source code must retain the above copyright notice"))),
    Family("bsd-2-clause", "bsd", (r"(?:2|two)[- ]clause bsd licen[sc]e", r"simplified bsd licen[sc]e"), (r"bsd-2-clause",),
           (r"opensource\.org/licenses?/bsd-2-clause",)),
    Family("bsd-2-clause", "freebsd", (r"freebsd licen[sc]e",)),
    Family("bsd-3-clause", "bsd", (r"(?:3|three)[- ]clause bsd licen[sc]e", r"(?:new|revised|modified) bsd licen[sc]e"), (r"bsd-3-clause",),
           (r"opensource\.org/licenses?/bsd-3-clause",), (("endorse", r"neither the name of .{1,80}? nor the names of its contributors may be used to endorse"),)),
    Family("bsd-4-clause", "bsd", (r"(?:4|four)[- ]clause bsd licen[sc]e", r"original bsd licen[sc]e"), (r"bsd-4-clause",), (),
           (("advertising", r"all advertising materials mentioning features or use of this software must display"),)),
    Family("0bsd", "bsd", (r"zero[- ]clause bsd licen[sc]e", r"bsd zero[- ]clause licen[sc]e"), (r"0bsd",)),
    Family("isc", "isc", (r"isc licen[sc]e",), (r"isc",), (r"opensource\.org/licenses?/isc",),
           (("permission", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose with or without fee is hereby granted"),)),
    Family("mpl-1.1", "mozilla", (rf"mozilla public licen[sc]e{_V}1\.1",), (r"mpl-1\.1",), (r"mozilla\.org/mpl/1\.1", r"mozilla\.org/mpl/mpl-1\.1")),
    Family("mpl-2.0", "mozilla", (rf"mozilla public licen[sc]e(?:{_V}2(?:\.0)?)?",), (r"mpl(?:-2\.0)?",), (r"mozilla\.org/mpl/2\.0", r"mozilla\.org/mpl"),
           (("mozilla", r"this source code form is subject to the terms of the mozilla public license"),)),
    Family("epl-1.0", "eclipse", (rf"eclipse public licen[sc]e(?:{_V}1\.0)?",), (r"epl(?:-1\.0)?",), (r"eclipse\.org/legal/epl-v10",)),
    Family("epl-2.0", "eclipse", (rf"eclipse public licen[sc]e{_V}2\.0",), (r"epl-2\.0",), (r"eclipse\.org/legal/epl-2\.0", r"eclipse\.org/legal/epl-v20")),
    Family("edl-1.0", "eclipse", (r"eclipse distribution licen[sc]e",), (r"edl(?:-1\.0)?",), (r"eclipse\.org/org/documents/edl",)),
    Family("cddl", "common", (r"common development and distribution licen[sc]e",), (r"cddl(?:-1\.[01])?",), (r"opensource\.org/licenses?/cddl",)),
    Family("cpl-1.0", "common", (r"common public licen[sc]e",), (r"cpl(?:-1\.0)?",), (r"opensource\.org/licenses?/cpl",)),
    Family("eupl", "european", (r"european union public licen[sc]e",), (r"eupl(?:-1\.[0-2])?",), (r"joinup\.ec\.europa\.eu/.{0,60}?eupl",)),
    Family("artistic", "artistic", (r"artistic licen[sc]e(?:,? ?(?:version )?[12]\.0)?",), (r"artistic-[12]\.0",), (r"opensource\.org/licenses?/artistic",)),
    Family("boost", "boost", (r"boost software licen[sc]e",), (r"bsl-1\.0",), (r"boost\.org/license_1_0",)),
    Family("zlib", "zlib", (r"zlib licen[sc]e", r"zlib/libpng licen[sc]e"), (r"zlib",), (r"opensource\.org/licenses?/zlib",),
           (("altered", r"altered source versions must be plainly marked as such"),)),
    Family("libpng", "libpng", (r"libpng licen[sc]e",), (r"libpng",)),
    Family("unlicense", "unlicense", (r"the unlicense",), (r"unlicense",), (r"unlicense\.org",),
           (("encumbered", r"this is free and unencumbered software released into the public domain"),)),
    Family("wtfpl", "wtfpl", (r"wtfpl licen[sc]e",), (r"wtfpl",), (r"wtfpl\.net",)),
    Family("python", "python", (r"python software foundation licen[sc]e",), (r"psf-2\.0", r"python-2\.0"), (r"python\.org/.{0,20}?license",)),
    Family("python", "psf", (r"psf licen[sc]e agreement",)),
    Family("ruby", "ruby", (r"ruby licen[sc]e",), (r"ruby",), (r"ruby-lang\.org/.{0,20}?license",)),
    Family("php", "php", (r"php licen[sc]e",), (r"php-3\.0[01]?",), (r"php\.net/license",)),
    Family("postgresql", "postgresql", (r"postgresql licen[sc]e",), (r"postgresql",), (r"opensource\.org/licenses?/postgresql",)),
    Family("openssl", "openssl", (r"openssl licen[sc]e",), (r"openssl",), (r"openssl\.org/source/license",)),
    Family("curl", "curl", (r"curl licen[sc]e",), (r"curl",), (r"curl\.se/docs/copyright", r"curl\.haxx\.se/docs/copyright")),
    Family("ncsa", "ncsa", (r"university of illinois/ncsa open source licen[sc]e", r"ncsa licen[sc]e"), (r"ncsa",)),
    Family("upl-1.0", "universal", (r"universal permissive licen[sc]e",), (r"upl(?:-1\.0)?",), (r"oss\.oracle\.com/licenses/upl",)),
    Family("afl", "academic", (r"academic free licen[sc]e",), (r"afl-[1-3]\.[0-2]",)),
    Family("osl", "open", (r"open software licen[sc]e",), (r"osl-[1-3]\.[0-2]",)),
    Family("ofl", "open", (r"sil open font licen[sc]e", r"open font licen[sc]e"), (r"ofl(?:-1\.[01])?",), (r"scripts\.sil\.org/ofl", r"openfontlicense\.org")),
    Family("odbl", "open", (r"open database licen[sc]e", r"open data commons open database licen[sc]e"), (r"odbl(?:-1\.0)?",), (r"opendatacommons\.org/licenses/odbl",)),
    Family("odc-by", "open", (r"open data commons attribution licen[sc]e",), (r"odc-by(?:-1\.0)?",), (r"opendatacommons\.org/licenses/by",)),
    Family("pddl", "public", (r"public domain dedication and licen[sc]e",), (r"pddl(?:-1\.0)?",), (r"opendatacommons\.org/licenses/pddl",)),
    Family("cc0-1.0", "cc0", (r"cc0(?: 1\.0)? universal", r"cc0 licen[sc]e"), (r"cc0(?:[- ]1\.0)?",), (r"creativecommons\.org/publicdomain/zero",)),
    Family("cc-by", "creative", (r"creative commons attribution(?: [1-4]\.[05])?(?: international| unported)?(?: public)? licen[sc]e",), (r"cc[- ]by(?:[- ][1-4]\.[05])?",),
           (r"creativecommons\.org/licenses/by/",)),
    Family("cc-by-sa", "creative", (r"creative commons attribution[- ]share ?alike(?: [1-4]\.[05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?",),
           (r"cc[- ]by[- ]sa(?:[- ][1-4]\.[05])?",), (r"creativecommons\.org/licenses/by-sa/",)),
    Family("cc-by-nc", "creative", (r"creative commons attribution[- ]non ?commercial(?: [1-4]\.[05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?",),
           (r"cc[- ]by[- ]nc(?:[- ][1-4]\.[05])?",), (r"creativecommons\.org/licenses/by-nc/",)),
    Family("cc-by-nd", "creative", (r"creative commons attribution[- ]no ?derivatives(?: [1-4]\.[05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?",),
           (r"cc[- ]by[- ]nd(?:[- ][1-4]\.[05])?",), (r"creativecommons\.org/licenses/by-nd/",)),
    Family("cc-by-nc-sa", "creative", (r"creative commons attribution[- ]non ?commercial[- ]share ?alike(?: [1-4]\.[05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?",),
           (r"cc[- ]by[- ]nc[- ]sa(?:[- ][1-4]\.[05])?",), (r"creativecommons\.org/licenses/by-nc-sa/",)),
    Family("cc-by-nc-nd", "creative", (r"creative commons attribution[- ]non ?commercial[- ]no ?derivatives(?: [1-4]\.[05])?(?: international| unported)?(?: public)?(?: licen[sc]e)?",),
           (r"cc[- ]by[- ]nc[- ]nd(?:[- ][1-4]\.[05])?",), (r"creativecommons\.org/licenses/by-nc-nd/",)),
    Family("sspl-1.0", "server", (r"server side public licen[sc]e",), (r"sspl(?:-1\.0)?",), (r"mongodb\.com/licensing/server-side-public-license",)),
    Family("busl-1.1", "business", (r"business source licen[sc]e",), (r"busl(?:-1\.1)?",), (r"mariadb\.com/bsl11",)),
    Family("elastic-2.0", "elastic", (r"elastic licen[sc]e(?: 2\.0)?",), (r"elastic-2\.0",), (r"elastic\.co/licensing/elastic-license",)),
    Family("ms-pl", "microsoft", (r"microsoft public licen[sc]e",), (r"ms-pl",), (r"opensource\.org/licenses?/ms-pl",)),
    Family("ms-rl", "microsoft", (r"microsoft reciprocal licen[sc]e",), (r"ms-rl",), (r"opensource\.org/licenses?/ms-rl",)),
    Family("public-domain", "public", (r"public domain",), (), (), (("public", r"(?:released|placed|dedicated) (?:in)?to the public domain"),)),
    Family("proprietary", "reserved", (r"all rights reserved",), (), (),
           (("confidential", r"confidential and proprietary"), ("unauthorized", r"unauthorized (?:copying|reproduction|distribution) of this (?:file|document|software)"))),
)

#: How a licence is named in a statement; ``{}`` is a title or an identifier.
_STATEMENTS = (
    r"(?:licensed|released|distributed|available|published|provided|covered) under (?:the )?(?:terms of (?:the )?)?{}",
    r"subject to (?:the )?(?:terms of (?:the )?)?{}",
    r"use of this (?:source code|file|work|software) is governed by (?:the |an? )?{}",
)


def _head(pattern: str) -> str:
    """The word that every text with this pattern has: the plain letters and digits it begins with."""
    return re.match("[a-z0-9]+", pattern)[0]


def rules() -> tuple[Rule, ...]:
    """All rules, in the order of their numbers."""
    made: list[tuple[str, str, str, str]] = []
    for family in FAMILIES:
        label = family.label
        made += [(label, "notice", keyword, pattern) for keyword, pattern in family.notices]
        for statement in _STATEMENTS:
            title = statement.format(f"(?:{'|'.join(family.titles)})")
            made.append((label, "statement", family.keyword, title + r"(?![\w-])"))
        for name in family.identifiers:
            named = "(?:" + "|".join(_STATEMENTS).format(*[f"(?:{name})"] * len(_STATEMENTS)) + r")(?![\w+-]|\.\d)"
            made.append((label, "statement", _head(name), named))
            made.append((label, "identifier", _head(name), rf"spdx-license-identifier: ?(?:{name})(?![\w+-]|\.\d)"))
            made.append((label, "identifier", _head(name), rf"licen[sc]e ?[:=] ?[\"']?(?:{name})(?![\w+-]|\.\d)"))
        made += [(label, "address", _head(place), rf"https?://(?:www\.)?{place}") for place in family.addresses]
        made += [(label, "title", family.keyword, rf"(?<![\w-]){title}(?![\w-])") for title in family.titles]
    return tuple(Rule(i, *rule) for i, rule in enumerate(made))
