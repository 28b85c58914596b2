"""Signature rules of the license scan: hand-written patterns over normalised words.

A rule is (label, priority, keyword, pattern). The pattern runs only over texts that hold the keyword, or one of
several, parted by `|`; every match of the pattern holds one of them. Words are lower-case and joined by single spaces. `V` stands for a version such as "2", "v2 1" or "version 2 0",
`W` for one word, `GAP` for up to four words. A lower priority number wins over a higher one.
"""

from __future__ import annotations

V = r"(?:v|version |v )?[0-9](?: [0-9]){0,2}"
W = r"[^ ]+"
GAP = r"(?:[^ ]+ ){0,4}?"

#: Priorities: an identifier line, a notice that names its license, a sentence of a license text, a bare mention.
TAG, NOTICE, SENTENCE, MENTION = 0, 1, 2, 3

#: Base phrases, fixed by the contract. They are never suppressed.
BASE = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Families that share their wording: label, name in words, versions.
FAMILIES = [
    ("gpl", "gnu general public license", ["1", "2", "3"]),
    ("lgpl", "gnu lesser general public license", ["2 1", "3"]),
    ("lgpl", "gnu library general public license", ["2"]),
    ("agpl", "gnu affero general public license", ["1", "3"]),
    ("gfdl", "gnu free documentation license", ["1 1", "1 2", "1 3"]),
    ("apache", "apache license", ["1 0", "1 1", "2 0"]),
    ("mpl", "mozilla public license", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse public license", ["1 0", "2 0"]),
    ("cddl", "common development and distribution license", ["1 0", "1 1"]),
    ("cpl", "common public license", ["0 5", "1 0"]),
    ("eupl", "european union public licence", ["1 0", "1 1", "1 2"]),
    ("osl", "open software license", ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("afl", "academic free license", ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", "artistic license", ["1 0", "2 0"]),
    ("bsl", "boost software license", ["1 0"]),
    ("zpl", "zope public license", ["1 1", "2 0", "2 1"]),
    ("ecl", "educational community license", ["1 0", "2 0"]),
    ("apsl", "apple public source license", ["1 0", "1 1", "1 2", "2 0"]),
    ("ofl", "sil open font license", ["1 0", "1 1"]),
    ("cecill", "cecill free software license agreement", ["1 0", "2 0", "2 1"]),
    ("lppl", "latex project public license", ["1 0", "1 1", "1 2", "1 3"]),
    ("php", "php license", ["3 0", "3 01"]),
    ("qpl", "q public license", ["1 0"]),
    ("upl", "universal permissive license", ["1 0"]),
    ("mulan", "mulan permissive software license", ["1", "2"]),
    ("busl", "business source license", ["1 0", "1 1"]),
    ("sspl", "server side public license", ["1"]),
    ("elastic", "elastic license", ["2 0"]),
    ("odbl", "open database license", ["1 0"]),
    ("ncsa", "university of illinois ncsa open source license", ["1 0"]),
    ("w3c", "w3c software notice and license", ["1 0"]),
    ("vim", "vim license", ["1 0"]),
    ("ipl", "ibm public license", ["1 0"]),
    ("ms-pl", "microsoft public license", ["1 0"]),
    ("ms-rl", "microsoft reciprocal license", ["1 0"]),
    ("cc0", "creative commons zero", ["1 0"]),
]

#: Identifiers as they stand in tag lines, after splitting into words.
TAGS = {
    "mit": "mit", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "wtfpl": "wtfpl", "bsd 2 clause": "bsd-2", "bsd 3 clause": "bsd-3",
    "bsd 4 clause": "bsd-4", "0bsd": "0bsd", "apache 2 0": "apache-2.0", "apache 1 1": "apache-1.1", "gpl 1 0": "gpl-1", "gpl 2 0": "gpl-2",
    "gpl 3 0": "gpl-3", "lgpl 2 0": "lgpl-2", "lgpl 2 1": "lgpl-2.1", "lgpl 3 0": "lgpl-3", "agpl 3 0": "agpl-3", "mpl 1 1": "mpl-1.1",
    "mpl 2 0": "mpl-2.0", "epl 1 0": "epl-1.0", "epl 2 0": "epl-2.0", "cddl 1 0": "cddl-1.0", "bsl 1 0": "bsl-1.0", "cc0 1 0": "cc0-1.0",
    "cc by 4 0": "cc-by-4.0", "cc by sa 4 0": "cc-by-sa-4.0", "cc by nc 4 0": "cc-by-nc-4.0", "cc by nd 4 0": "cc-by-nd-4.0", "ofl 1 1": "ofl-1.1",
    "artistic 2 0": "artistic-2.0", "eupl 1 2": "eupl-1.2", "postgresql": "postgresql", "python 2 0": "python-2", "ncsa": "ncsa", "x11": "x11",
}

#: Hand-written notices and sentences.
WRITTEN = [
    ("mit", NOTICE, "mit", rf"(?:released|licensed|distributed|available|provided) under {GAP}(?:the )?(?:terms of the )?mit licen[cs]e"),
    ("mit", SENTENCE, "free of charge", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", SENTENCE, "sublicense", r"to use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", SENTENCE, "permission notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", MENTION, "mit", r"(?:the )?mit licen[cs]e"),
    ("mit", MENTION, "expat", r"expat licen[cs]e"),
    ("mit-0", NOTICE, "attribution", r"mit no attribution"),
    ("x11", MENTION, "x11", r"x11 licen[cs]e"),
    ("bsd", NOTICE, "bsd", rf"(?:released|licensed|distributed|available) under {GAP}(?:new |modified |simplified |revised )?bsd(?: style)? licen[cs]e"),
    ("bsd-2", NOTICE, "clause", r"(?:2|two) clause bsd"),
    ("bsd-3", NOTICE, "clause", r"(?:3|three) clause bsd"),
    ("bsd-4", NOTICE, "clause", r"(?:4|four) clause bsd"),
    ("bsd", SENTENCE, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", SENTENCE, "redistributions", r"redistributions of source code must retain the (?:above )?copyright notice"),
    ("bsd", SENTENCE, "redistributions", r"redistributions in binary form must reproduce the (?:above )?copyright notice"),
    ("bsd-3", SENTENCE, "endorse", rf"neither the names? of {GAP}(?:nor )?{GAP}contributors may be used to endorse or promote"),
    ("bsd-4", SENTENCE, "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd", MENTION, "bsd", r"bsd(?: style)? licen[cs]e"),
    ("isc", SENTENCE, "permission to use", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee"),
    ("isc", MENTION, "isc", r"isc licen[cs]e"),
    ("zlib", SENTENCE, "as is", r"this software is provided as is without any express or implied warranty"),
    ("zlib", SENTENCE, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", SENTENCE, "altered", r"altered source versions must be plainly marked as such"),
    ("zlib", MENTION, "zlib", r"zlib(?: libpng)? licen[cs]e"),
    ("apache", MENTION, "apache", rf"licensed under the apache licen[cs]e {V}"),
    ("apache", SENTENCE, "in compliance", r"you may not use this file except in compliance with the license"),
    ("apache", SENTENCE, "obtain a copy", r"you may obtain a copy of the license at"),
    ("apache", SENTENCE, "without warranties", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("apache", SENTENCE, "contributor license", r"contributor license agreements?"),
    ("apache-1.1", SENTENCE, "apache software foundation", r"this product includes software developed by the apache software foundation"),
    ("gpl", NOTICE, "free software", r"this (?:program|library|file|software) is free software you can redistribute it and or modify it"),
    ("gpl", SENTENCE, "fitness", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", SENTENCE, "received a copy", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public license"),
    ("gpl", SENTENCE, "any later version", r"either version [0-9] (?:[0-9] )?of the license or (?:at your option )?any later version"),
    ("gpl", SENTENCE, "copyleft", rf"copyleft {GAP}(?:licen[cs]e|notice)"),
    ("gpl", MENTION, "gnu gpl", rf"gnu gpl(?: {V})?"),
    ("gpl", MENTION, "gplv", r"gplv[123]"),
    ("lgpl", MENTION, "gnu lgpl", rf"gnu lgpl(?: {V})?"),
    ("lgpl", MENTION, "lgplv", r"lgplv[23](?: 1)?"),
    ("agpl", MENTION, "gnu agpl", rf"gnu agpl(?: {V})?"),
    ("agpl", MENTION, "agplv", r"agplv3"),
    ("gpl-exception", NOTICE, "linking exception", rf"(?:special |classpath |runtime )?{GAP}linking exception"),
    ("gpl-exception", NOTICE, "special exception", r"as a special exception"),
    ("mpl", SENTENCE, "source code form", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", SENTENCE, "subject to the mozilla", r"the contents of this file are subject to the mozilla public license"),
    ("cc-by", NOTICE, "attribution", rf"creative commons attribution(?: [0-9] [0-9])?(?: international| unported| generic)?(?: (?:public )?licen[cs]e)?"),
    ("cc-by-sa", NOTICE, "share", rf"(?:creative commons )?attribution share ?alike(?: [0-9] [0-9])?"),
    ("cc-by-nc", NOTICE, "commercial", rf"(?:creative commons )?attribution non ?commercial(?: [0-9] [0-9])?"),
    ("cc-by-nc-sa", NOTICE, "commercial", r"attribution non ?commercial share ?alike"),
    ("cc-by-nc-nd", NOTICE, "commercial", r"attribution non ?commercial no ?deriv(?:ative)?s?"),
    ("cc-by-nd", NOTICE, "deriv", r"(?:creative commons )?attribution no ?deriv(?:ative)?s?"),
    ("cc-by-sa", NOTICE, "cc by", r"cc by sa(?: [0-9](?: [0-9])?)?"),
    ("cc-by-nc", NOTICE, "cc by", r"cc by nc(?: [0-9](?: [0-9])?)?"),
    ("cc-by-nc-sa", NOTICE, "cc by", r"cc by nc sa(?: [0-9](?: [0-9])?)?"),
    ("cc-by-nd", NOTICE, "cc by", r"cc by nd(?: [0-9](?: [0-9])?)?"),
    ("cc-by-nc-nd", NOTICE, "cc by", r"cc by nc nd(?: [0-9](?: [0-9])?)?"),
    ("cc-by", MENTION, "cc by", r"cc by(?: [1-4](?: [0-9])?)?"),
    ("cc-by", MENTION, "creativecommons", r"creativecommons org licenses by [0-9](?: [0-9])?"),
    ("cc-by-sa", NOTICE, "creativecommons", r"creativecommons org licenses by sa [0-9](?: [0-9])?"),
    ("cc-by-nc", NOTICE, "creativecommons", r"creativecommons org licenses by nc [0-9](?: [0-9])?"),
    ("cc0", NOTICE, "creativecommons", r"creativecommons org publicdomain zero"),
    ("cc0", NOTICE, "cc0", r"cc0(?: [0-9] [0-9])?(?: universal)?"),
    ("cc", MENTION, "creative commons", r"creative commons licen[cs]e"),
    ("public-domain", NOTICE, "public domain", r"(?:released|placed|dedicated|put) (?:in|into|to) the public domain"),
    ("public-domain", MENTION, "public domain", r"(?:is in the )?public domain"),
    ("unlicense", SENTENCE, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", MENTION, "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", NOTICE, "do what the", rf"do what the {W} you want to(?: public licen[cs]e)?"),
    ("beerware", NOTICE, "beer", r"beer ?ware licen[cs]e"),
    ("boost", SENTENCE, "machine executable", r"machine executable object code generated by a source language processor"),
    ("artistic", SENTENCE, "standard version", r"make verbatim copies of the source form of the standard version"),
    ("python", NOTICE, "python software foundation", r"python software foundation licen[cs]e(?: version [0-9])?"),
    ("openssl", NOTICE, "openssl", r"openssl licen[cs]e"),
    ("openssl", SENTENCE, "openssl", r"developed by the openssl project for use in the openssl toolkit"),
    ("postgresql", MENTION, "postgresql", r"postgresql licen[cs]e"),
    ("curl", MENTION, "curl", r"curl licen[cs]e"),
    ("ftl", MENTION, "freetype", r"freetype (?:project )?licen[cs]e"),
    ("ijg", SENTENCE, "independent jpeg", r"based in part on the work of the independent jpeg group"),
    ("libpng", MENTION, "libpng", r"libpng licen[cs]e"),
    ("ruby", MENTION, "ruby", r"ruby licen[cs]e"),
    ("perl", NOTICE, "perl itself", r"under the same terms as perl itself"),
    ("json", SENTENCE, "good not evil", r"the software shall be used for good not evil"),
    ("unicode", NOTICE, "unicode", r"unicode (?:inc )?licen[cs]e agreement"),
    ("ofl", SENTENCE, "reserved font name", r"(?:with )?reserved font names?"),
    ("gfdl", SENTENCE, "invariant sections", r"with no invariant sections no front cover texts and no back cover texts"),
    ("dual", NOTICE, "dual licensed", r"dual licensed(?: under)?"),
    ("dual", NOTICE, "multi licensed", r"multi licensed(?: under)?"),
    ("proprietary", NOTICE, "proprietary", r"proprietary and confidential"),
    ("proprietary", SENTENCE, "reproduced", rf"no part of this {W} may be reproduced"),
    ("proprietary", SENTENCE, "unauthori", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)"),
    ("proprietary", SENTENCE, "trade secret", r"(?:contains )?trade secrets?"),
    ("proprietary", SENTENCE, "reverse engineer", r"reverse engineer(?:ing)? decompil(?:e|ing) or disassembl(?:e|ing)"),
    ("proprietary", SENTENCE, "written permission|written consent", rf"without (?:the )?(?:prior |express )?written (?:permission|consent)"),
    ("eula", NOTICE, "end user licen", r"end user licen[cs]e agreement"),
    ("eula", SENTENCE, "by installing", rf"by installing {GAP}you agree"),
    ("non-commercial", NOTICE, "commercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?"),
    ("research-only", NOTICE, "use only|purposes only", r"(?:for )?(?:academic|research) (?:use|purposes) only"),
    ("evaluation", NOTICE, "evaluation", r"evaluation (?:licen[cs]e|purposes only)"),
    ("shareware", MENTION, "shareware", r"shareware"),
    ("freeware", MENTION, "freeware", r"freeware"),
    ("reserved", MENTION, "rights reserved", r"(?:all|some|no) rights reserved"),
    ("copyright", MENTION, "copyright", r"copyright (?:c )?(?:[12][0-9]{3})(?: [12][0-9]{3})*"),
    ("copyright", MENTION, "copyright", r"copyright (?:c )?by"),
    ("copyright", MENTION, "copyrighted", r"copyrighted (?:material|work)"),
    ("warranty", SENTENCE, "warranty", r"provided as is without warranty of any kind"),
    ("warranty", SENTENCE, "warranties", r"express or implied warranties including but not limited to"),
    ("warranty", SENTENCE, "liable", rf"in no event shall {GAP}(?:authors|copyright holders?|contributors|owner) {GAP}be liable"),
    ("license-file", MENTION, "license", r"see (?:the )?(?:accompanying )?(?:file )?license(?: txt| md)? (?:file )?(?:for|in)"),
    ("license-file", MENTION, "copying", r"see (?:the )?(?:file )?copying(?: txt)? (?:file )?(?:for|in)"),
    ("license", MENTION, "license", r"licensed under the terms of"),
    ("license", MENTION, "licensed", r"is licensed under"),
]


def family_rules() -> list[tuple[str, int, str, str]]:
    """For each version a notice and a tag-like form, for each family a mention."""
    rules = []
    for label, name, versions in FAMILIES:
        spelt = name.replace("license", "licen[cs]e").replace("licence", "licen[cs]e")
        short = name.split(" licen")[0]
        rules.append((label, MENTION, short, rf"(?:the )?{spelt}"))
        for version in versions:
            number = version[:-2] if version.endswith(" 0") else version
            exact = f"{label}-{version.replace(' ', '.')}"
            rules.append((exact, NOTICE, short, rf"{spelt} (?:as published by {GAP})?(?:v|version |v )?{number}(?: 0)?(?: only| or (?:any )?later)?"))
            rules.append((exact, NOTICE, label.replace("-", " "), rf"{label.replace('-', ' ')} ?v?(?:ersion )?{number}(?: 0)?(?: only| or later| licen[cs]e)"))
            rules.append((exact, NOTICE, short, rf"version {number}(?: 0)? of the {spelt}"))
    return rules


def tag_rules() -> list[tuple[str, int, str, str]]:
    """Identifier lines and `license: X` fields."""
    rules = []
    for words, label in TAGS.items():
        rules.append((label, TAG, "spdx", rf"spdx license identifier {words}(?: only| or later)?"))
        rules.append((label, TAG, "licen", rf"licen[cs]e (?:id |name |type )?{words}(?: only| or later| licen[cs]e)?"))
    return rules


def rules() -> list[tuple[str, int, str, str]]:
    """All rules in order: base phrases first, then by priority, stable."""
    base = [(label, TAG, phrase, phrase) for phrase, label in BASE]
    return base + sorted(tag_rules() + WRITTEN + family_rules(), key=lambda r: r[1])
