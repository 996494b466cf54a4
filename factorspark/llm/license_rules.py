"""Signature rules of the license scan.

A rule is written over the words of a text, lower case, one space between two words; marks between words ("2.0", "BSD-3-Clause",
comment signs, line ends) are gone there, so "Version 2.0" is ``version 2 0``. A keyword gates its rules: they run only on texts
that hold it, and every match of a rule holds the rule's keyword.
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    kind: str
    keyword: str
    pattern: str


#: Every match of a rule of ``RULES`` holds one of these: texts without any are done after one cheap look at each.
STEMS = ("licen", "software", "gpl", "fdl", "gnu", "apache", "asl 2", "bsd", "mpl", "epl", "cddl", "cecill", "eupl", "wtfpl", "lppl", "commons", "cc by",
         "cc0", "domain", "no attribution", "endorse", "redistribution", "as perl", "reserved", "unauthorized", "proprietary", "sil org")

#: Kinds of rules: (priority, weight in the score).
KINDS = {"tag": (4, 1.0), "link": (3, 0.95), "grant": (2, 0.9), "name": (1, 0.7), "any": (0, 0.3)}


def _rules(label: str, *lines: tuple[str, str, str]) -> list[Rule]:
    return [Rule(label, *line) for line in lines]


V2, V3 = "(?:version |v )?(?:2|v2)(?: 0)?", "(?:version |v )?(?:3|v3)(?: 0)?"

RULES: list[Rule] = [
    # GNU
    *_rules("gpl-1.0", ("tag", "spdx", "spdx license identifier gpl 1 0(?: only| or later)?"), ("name", "gpl", "(?:gnu )?(?:gpl v?1(?: 0)?|gplv1)"),
            ("name", "licen", "gnu general public licen[cs]e (?:version |v )?(?:1|v1)(?: 0)?")),
    *_rules("gpl-2.0", ("tag", "spdx", "spdx license identifier gpl 2 0(?: only| or later)?"), ("link", "gnu", "gnu org licenses (?:old licenses )?gpl 2 0"),
            ("link", "opensource", "opensource org licenses gpl 2 0"),
            ("grant", "licen", "terms of the gnu general public licen[cs]e (?:as published by the free software foundation (?:either )?)?" + V2),
            ("grant", "licen", "licen[cs]ed under the gnu general public licen[cs]e " + V2), ("name", "licen", "gnu general public licen[cs]e " + V2),
            ("name", "gpl", "(?:gnu )?(?:gpl v?2(?: 0)?|gplv2)(?: or later| only)?")),
    *_rules("gpl-3.0", ("tag", "spdx", "spdx license identifier gpl 3 0(?: only| or later)?"), ("link", "gnu", "gnu org licenses gpl 3 0"),
            ("link", "opensource", "opensource org licenses gpl 3 0"),
            ("grant", "licen", "terms of the gnu general public licen[cs]e (?:as published by the free software foundation (?:either )?)?" + V3),
            ("grant", "licen", "licen[cs]ed under the gnu general public licen[cs]e " + V3), ("name", "licen", "gnu general public licen[cs]e " + V3),
            ("name", "gpl", "(?:gnu )?(?:gpl v?3(?: 0)?|gplv3)(?: or later| only)?")),
    *_rules("lgpl-2.0", ("tag", "spdx", "spdx license identifier lgpl 2 0(?: only| or later)?"), ("name", "lgpl", "(?:gnu )?lgpl v?2 0"),
            ("name", "licen", "gnu library general public licen[cs]e(?: version 2(?: 0)?)?")),
    *_rules("lgpl-2.1", ("tag", "spdx", "spdx license identifier lgpl 2 1(?: only| or later)?"), ("link", "gnu", "gnu org licenses (?:old licenses )?lgpl 2 1"),
            ("name", "licen", "gnu lesser general public licen[cs]e (?:version |v )?2 1"), ("name", "lgpl", "(?:gnu )?(?:lgpl v?2 1|lgplv2 1|lgplv2)")),
    *_rules("lgpl-3.0", ("tag", "spdx", "spdx license identifier lgpl 3 0(?: only| or later)?"), ("link", "gnu", "gnu org licenses lgpl 3 0"),
            ("name", "licen", "gnu lesser general public licen[cs]e " + V3), ("name", "lgpl", "(?:gnu )?(?:lgpl v?3(?: 0)?|lgplv3)")),
    *_rules("agpl-3.0", ("tag", "spdx", "spdx license identifier agpl 3 0(?: only| or later)?"), ("link", "gnu", "gnu org licenses agpl 3 0"),
            ("name", "licen", "gnu affero general public licen[cs]e(?: " + V3 + ")?"), ("name", "agpl", "(?:gnu )?(?:agpl v?3(?: 0)?|agplv3)")),
    *_rules("gfdl-1.2", ("tag", "spdx", "spdx license identifier gfdl 1 2(?: only| or later)?"), ("name", "gfdl", "gfdl v?1 2"),
            ("name", "licen", "gnu free documentation licen[cs]e version 1 2")),
    *_rules("gfdl-1.3", ("tag", "spdx", "spdx license identifier gfdl 1 3(?: only| or later)?"), ("link", "gnu", "gnu org licenses fdl 1 3"),
            ("name", "gfdl", "gfdl v?1 3"), ("name", "licen", "gnu free documentation licen[cs]e version 1 3")),
    *_rules("gpl-any", ("link", "gnu", "gnu org (?:licenses|copyleft) gpl(?: html)?"), ("grant", "licen", "terms of the gnu general public licen[cs]e"),
            ("name", "licen", "gnu general public licen[cs]e"), ("name", "gpl", "gnu gpl"), ("name", "gpl", "(?:under|with) the gpl(?: licen[cs]e)?")),
    *_rules("lgpl-any", ("link", "gnu", "gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html)?"), ("name", "licen", "gnu lesser general public licen[cs]e"),
            ("name", "lgpl", "(?:gnu|the) lgpl(?: licen[cs]e)?")),
    *_rules("gfdl-any", ("link", "gnu", "gnu org (?:licenses|copyleft) fdl(?: html)?"), ("name", "licen", "gnu free documentation licen[cs]e"),
            ("name", "fdl", "gnu (?:gfdl|fdl)")),
    # permissive
    *_rules("apache-1.1", ("tag", "spdx", "spdx license identifier apache 1 1"), ("name", "apache", "apache (?:software )?licen[cs]e (?:version |v )?1 1")),
    *_rules("apache-2.0", ("tag", "spdx", "spdx license identifier apache 2 0"), ("link", "apache", "apache org licenses license 2 0(?: txt| html)?"),
            ("link", "opensource", "opensource org licenses apache 2 0"), ("grant", "apache", "licen[cs]ed under the apache licen[cs]e " + V2),
            ("grant", "apache", "terms of the apache licen[cs]e " + V2), ("name", "apache", "apache (?:software )?licen[cs]e " + V2),
            ("name", "apache", "apache 2(?: 0)?(?: licen[cs]ed?)?"), ("name", "asl 2", "asl 2 0")),
    *_rules("apache-any", ("link", "apache", "apache org licenses"), ("grant", "apache", "licen[cs]ed under the apache licen[cs]e"),
            ("name", "apache", "apache (?:software )?licen[cs]e")),
    *_rules("mit", ("tag", "spdx", "spdx license identifier mit"), ("link", "opensource", "opensource org licenses mit(?: license(?: php| html)?)?"),
            ("grant", "free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
            ("grant", "mit lic", "(?:released|licen[cs]ed|distributed|available) under the (?:terms of the )?mit licen[cs]e"),
            ("grant", "warranty", "the software is provided as is without warranty of any kind express or implied"),
            ("name", "mit lic", "(?:the )?mit licen[cs]e"), ("name", "expat", "expat licen[cs]e"), ("name", "mit lic", "mit licen[cs]ed")),
    *_rules("mit-0", ("tag", "spdx", "spdx license identifier mit 0"), ("name", "no attribution", "mit no attribution(?: licen[cs]e)?")),
    *_rules("x11", ("tag", "spdx", "spdx license identifier x11"), ("name", "x11", "x11 licen[cs]e")),
    *_rules("bsd-1-clause", ("tag", "spdx", "spdx license identifier bsd 1 clause"), ("name", "bsd", "bsd 1 clause(?: licen[cs]e)?")),
    *_rules("bsd-2-clause", ("tag", "spdx", "spdx license identifier bsd 2 clause"), ("link", "opensource", "opensource org licenses bsd 2 clause"),
            ("name", "licen", "(?:simplified bsd|freebsd) licen[cs]e"), ("name", "bsd", "bsd (?:2|two) clause(?: licen[cs]e)?"),
            ("name", "bsd", "(?:2|two) clause bsd(?: licen[cs]e)?")),
    *_rules("bsd-3-clause", ("tag", "spdx", "spdx license identifier bsd 3 clause"), ("link", "opensource", "opensource org licenses bsd 3 clause"),
            ("grant", "endorse", "names? of (?:its|the) (?:contributors|copyright holders?) (?:nor the names of its contributors )?may be used to endorse or promote"),
            ("name", "licen", "(?:new|modified|revised) bsd licen[cs]e"), ("name", "bsd", "bsd (?:3|three) clause(?: licen[cs]e)?"),
            ("name", "bsd", "(?:3|three) clause bsd(?: licen[cs]e)?")),
    *_rules("bsd-4-clause", ("tag", "spdx", "spdx license identifier bsd 4 clause"),
            ("grant", "advertising", "all advertising materials mentioning features or use of this software must display"),
            ("name", "bsd", "(?:original bsd licen[cs]e|bsd 4 clause)")),
    *_rules("0bsd", ("tag", "spdx", "spdx license identifier 0bsd"), ("name", "bsd", "(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?")),
    *_rules("bsd-any", ("grant", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
            ("name", "licen", "bsd(?: style)? licen[cs]ed?"), ("name", "bsd", "berkeley software distribution bsd")),
    *_rules("isc", ("tag", "spdx", "spdx license identifier isc"), ("link", "opensource", "opensource org licenses isc"),
            ("grant", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
            ("name", "licen", "(?:the )?isc licen[cs]e")),
    *_rules("zlib", ("tag", "spdx", "spdx license identifier zlib"),
            ("grant", "misrepresented", "the origin of this software must not be misrepresented"), ("name", "zlib", "zlib (?:libpng )?licen[cs]e")),
    *_rules("libpng", ("tag", "spdx", "spdx license identifier libpng(?: 2 0)?"), ("name", "libpng", "libpng licen[cs]e")),
    *_rules("bsl-1.0", ("tag", "spdx", "spdx license identifier bsl 1 0"), ("link", "boost", "boost org license 1 0 txt"),
            ("name", "boost", "boost software licen[cs]e(?: version 1 0)?")),
    *_rules("unlicense", ("tag", "spdx", "spdx license identifier unlicense"), ("link", "unlicense", "unlicense org"),
            ("grant", "unencumbered", "this is free and unencumbered software released into the public domain"), ("name", "unlicense", "the unlicense")),
    *_rules("wtfpl", ("tag", "spdx", "spdx license identifier wtfpl"), ("link", "wtfpl", "wtfpl net"),
            ("name", "licen", "do what the fuck you want to public licen[cs]e"), ("name", "wtfpl", "wtfpl(?: v?2)?")),
    *_rules("artistic-1.0", ("tag", "spdx", "spdx license identifier artistic 1 0(?: perl)?"), ("name", "licen", "artistic licen[cs]e (?:version )?1 0")),
    *_rules("artistic-2.0", ("tag", "spdx", "spdx license identifier artistic 2 0"), ("link", "opensource", "opensource org licenses artistic license 2 0"),
            ("name", "licen", "artistic licen[cs]e (?:version )?2 0")),
    *_rules("artistic-any", ("name", "licen", "(?:the )?artistic licen[cs]e"), ("name", "as perl", "same terms as perl itself")),
    *_rules("psf-2.0", ("tag", "spdx", "spdx license identifier (?:psf|python) 2 0"), ("name", "licen", "(?:python software foundation|psf) licen[cs]e(?: version 2)?"),
            ("name", "licen", "psf licen[cs]e")),
    *_rules("php-3.01", ("tag", "spdx", "spdx license identifier php 3 0?1"), ("link", "php", "php net license 3 0?1(?: txt)?"),
            ("name", "php", "php licen[cs]e(?: version)? 3 0?1")),
    *_rules("ncsa", ("tag", "spdx", "spdx license identifier ncsa"), ("name", "ncsa", "(?:university of illinois )?ncsa open source licen[cs]e")),
    *_rules("curl", ("tag", "spdx", "spdx license identifier curl"), ("name", "licen", "curl licen[cs]e")),
    *_rules("openssl", ("tag", "spdx", "spdx license identifier openssl"), ("name", "openssl", "openssl (?:and ssleay )?licen[cs]e"),
            ("grant", "openssl", "this product includes software developed by the openssl project")),
    *_rules("postgresql", ("tag", "spdx", "spdx license identifier postgresql"), ("name", "postgresql", "postgresql licen[cs]e")),
    *_rules("ofl-1.1", ("tag", "spdx", "spdx license identifier ofl 1 1"), ("link", "scripts sil", "scripts sil org ofl"),
            ("name", "licen", "sil open font licen[cs]e(?: (?:version |v)?1 1)?"), ("name", "licen", "open font licen[cs]e")),
    *_rules("upl-1.0", ("tag", "spdx", "spdx license identifier upl 1 0"), ("name", "licen", "universal permissive licen[cs]e(?: v?1 0)?")),
    *_rules("afl-3.0", ("tag", "spdx", "spdx license identifier afl 3 0"), ("name", "licen", "academic free licen[cs]e(?: (?:version |v )?3 0)?")),
    *_rules("osl-3.0", ("tag", "spdx", "spdx license identifier osl 3 0"), ("name", "licen", "open software licen[cs]e(?: (?:version |v )?3 0)?")),
    *_rules("blueoak-1.0.0", ("tag", "spdx", "spdx license identifier blueoak 1 0 0"), ("name", "licen", "blue oak model licen[cs]e")),
    *_rules("beerware", ("tag", "spdx", "spdx license identifier beerware"), ("name", "licen", "beer ?ware licen[cs]e")),
    *_rules("json", ("tag", "spdx", "spdx license identifier json"), ("grant", "not evil", "the software shall be used for good not evil"), ("name", "json", "json licen[cs]e")),
    *_rules("ms-pl", ("tag", "spdx", "spdx license identifier ms pl"), ("name", "microsoft", "microsoft public licen[cs]e(?: ms pl)?")),
    *_rules("ms-rl", ("tag", "spdx", "spdx license identifier ms rl"), ("name", "microsoft", "microsoft reciprocal licen[cs]e(?: ms rl)?")),
    # weak copyleft and others
    *_rules("mpl-1.1", ("tag", "spdx", "spdx license identifier mpl 1 1"), ("link", "mozilla", "mozilla org mpl mpl 1 1(?: html)?"),
            ("name", "mozilla", "mozilla public licen[cs]e (?:version |v )?1 1")),
    *_rules("mpl-2.0", ("tag", "spdx", "spdx license identifier mpl 2 0"), ("link", "mozilla", "mozilla org (?:en us )?mpl 2 0"),
            ("grant", "mozilla", "subject to the terms of the mozilla public licen[cs]e v 2 0"), ("name", "mozilla", "mozilla public licen[cs]e " + V2),
            ("name", "mpl", "mpl v?2 0")),
    *_rules("mpl-any", ("name", "mozilla", "mozilla public licen[cs]e")),
    *_rules("epl-1.0", ("tag", "spdx", "spdx license identifier epl 1 0"), ("link", "eclipse", "eclipse org legal epl v10(?: html)?"),
            ("name", "eclipse", "eclipse public licen[cs]e (?:version |v )?1 0")),
    *_rules("epl-2.0", ("tag", "spdx", "spdx license identifier epl 2 0"), ("link", "eclipse", "eclipse org legal epl (?:2 0|v20)(?: html)?"),
            ("name", "eclipse", "eclipse public licen[cs]e " + V2)),
    *_rules("epl-any", ("name", "eclipse", "eclipse public licen[cs]e")),
    *_rules("cddl-1.0", ("tag", "spdx", "spdx license identifier cddl 1 0"), ("name", "cddl", "cddl (?:v |version )?1 0"),
            ("name", "licen", "common development and distribution licen[cs]e(?: cddl)?(?: version 1 0)?")),
    *_rules("cpl-1.0", ("tag", "spdx", "spdx license identifier cpl 1 0"), ("name", "licen", "common public licen[cs]e(?: version)? 1 0")),
    *_rules("eupl-1.1", ("tag", "spdx", "spdx license identifier eupl 1 1"), ("name", "eupl", "eupl v?(?: )?1 1")),
    *_rules("eupl-1.2", ("tag", "spdx", "spdx license identifier eupl 1 2"), ("name", "eupl", "eupl v?(?: )?1 2"),
            ("name", "licen", "european union public licen[cs]e(?: v 1 2)?")),
    *_rules("cecill-2.1", ("tag", "spdx", "spdx license identifier cecill 2 1"), ("link", "cecill", "cecill info licences"), ("name", "cecill", "cecill (?:v2 1|v 2 1|2 1)")),
    *_rules("cecill-b", ("tag", "spdx", "spdx license identifier cecill b"), ("name", "cecill", "cecill b(?: licen[cs]e)?")),
    *_rules("cecill-c", ("tag", "spdx", "spdx license identifier cecill c"), ("name", "cecill", "cecill c(?: licen[cs]e)?")),
    *_rules("ipl-1.0", ("tag", "spdx", "spdx license identifier ipl 1 0"), ("name", "licen", "ibm public licen[cs]e")),
    *_rules("qpl-1.0", ("tag", "spdx", "spdx license identifier qpl 1 0"), ("name", "licen", "q public licen[cs]e")),
    *_rules("sspl-1.0", ("tag", "spdx", "spdx license identifier sspl 1 0"), ("name", "licen", "server side public licen[cs]e")),
    *_rules("busl-1.1", ("tag", "spdx", "spdx license identifier busl 1 1"), ("name", "licen", "business source licen[cs]e(?: 1 1)?")),
    *_rules("elastic-2.0", ("tag", "spdx", "spdx license identifier elastic 2 0"), ("name", "elastic", "elastic licen[cs]e(?: v?2(?: 0)?)?")),
    *_rules("lppl-1.3c", ("tag", "spdx", "spdx license identifier lppl 1 3c"), ("link", "latex", "latex project org lppl(?: txt)?"),
            ("name", "latex", "latex project public licen[cs]e(?: version)?(?: 1 3c?)?")),
    *_rules("odbl-1.0", ("tag", "spdx", "spdx license identifier odbl 1 0"), ("link", "opendatacommons", "opendatacommons org licenses odbl"),
            ("name", "licen", "open (?:data commons open )?database licen[cs]e")),
    *_rules("odc-by-1.0", ("tag", "spdx", "spdx license identifier odc by 1 0"), ("link", "opendatacommons", "opendatacommons org licenses by"),
            ("name", "licen", "open data commons attribution licen[cs]e")),
    *_rules("pddl-1.0", ("tag", "spdx", "spdx license identifier pddl 1 0"), ("link", "opendatacommons", "opendatacommons org licenses pddl"),
            ("name", "dedication", "public domain dedication and licen[cs]e")),
    *_rules("ogl-uk-3.0", ("tag", "spdx", "spdx license identifier ogl uk 3 0"), ("link", "nationalarchives", "nationalarchives gov uk doc open government licence version 3"),
            ("name", "licen", "open government licen[cs]e(?: v ?3 0)?")),
    # Creative Commons
    *_rules("cc0-1.0", ("tag", "spdx", "spdx license identifier cc0 1 0"), ("link", "creativecommons", "creativecommons org publicdomain zero 1 0"),
            ("name", "cc0", "cc0(?: 1 0)?(?: universal)?"), ("name", "creative commons", "creative commons zero(?: v?1 0)?(?: universal)?")),
    *_rules("cc-by-2.0", ("tag", "spdx", "spdx license identifier cc by 2 0"), ("link", "creativecommons", "creativecommons org licenses by 2 0"), ("name", "cc by", "cc by 2 0"),
            ("name", "creative commons", "creative commons attribution 2 0")),
    *_rules("cc-by-3.0", ("tag", "spdx", "spdx license identifier cc by 3 0"), ("link", "creativecommons", "creativecommons org licenses by 3 0"), ("name", "cc by", "cc by 3 0"),
            ("name", "creative commons", "creative commons attribution 3 0")),
    *_rules("cc-by-4.0", ("tag", "spdx", "spdx license identifier cc by 4 0"), ("link", "creativecommons", "creativecommons org licenses by 4 0"), ("name", "cc by", "cc by 4 0"),
            ("name", "creative commons", "creative commons attribution 4 0(?: international)?")),
    *_rules("cc-by-sa-2.0", ("tag", "spdx", "spdx license identifier cc by sa 2 0"), ("link", "creativecommons", "creativecommons org licenses by sa 2 0"),
            ("name", "cc by", "cc by sa 2 0"), ("name", "creative commons", "creative commons attribution share ?alike 2 0")),
    *_rules("cc-by-sa-3.0", ("tag", "spdx", "spdx license identifier cc by sa 3 0"), ("link", "creativecommons", "creativecommons org licenses by sa 3 0"),
            ("name", "cc by", "cc by sa 3 0"), ("name", "creative commons", "creative commons attribution share ?alike 3 0")),
    *_rules("cc-by-sa-4.0", ("tag", "spdx", "spdx license identifier cc by sa 4 0"), ("link", "creativecommons", "creativecommons org licenses by sa 4 0"),
            ("name", "cc by", "cc by sa 4 0"), ("name", "creative commons", "creative commons attribution share ?alike 4 0(?: international)?")),
    *_rules("cc-by-nc-3.0", ("tag", "spdx", "spdx license identifier cc by nc 3 0"), ("link", "creativecommons", "creativecommons org licenses by nc 3 0"),
            ("name", "cc by", "cc by nc 3 0"), ("name", "creative commons", "creative commons attribution non ?commercial 3 0")),
    *_rules("cc-by-nc-4.0", ("tag", "spdx", "spdx license identifier cc by nc 4 0"), ("link", "creativecommons", "creativecommons org licenses by nc 4 0"),
            ("name", "cc by", "cc by nc 4 0"), ("name", "creative commons", "creative commons attribution non ?commercial 4 0(?: international)?")),
    *_rules("cc-by-nd-4.0", ("tag", "spdx", "spdx license identifier cc by nd 4 0"), ("link", "creativecommons", "creativecommons org licenses by nd 4 0"),
            ("name", "cc by", "cc by nd 4 0"), ("name", "creative commons", "creative commons attribution no ?deriv(?:ative)?s 4 0")),
    *_rules("cc-by-nc-sa-3.0", ("tag", "spdx", "spdx license identifier cc by nc sa 3 0"), ("link", "creativecommons", "creativecommons org licenses by nc sa 3 0"),
            ("name", "cc by", "cc by nc sa 3 0"), ("name", "creative commons", "creative commons attribution non ?commercial share ?alike 3 0")),
    *_rules("cc-by-nc-sa-4.0", ("tag", "spdx", "spdx license identifier cc by nc sa 4 0"), ("link", "creativecommons", "creativecommons org licenses by nc sa 4 0"),
            ("name", "cc by", "cc by nc sa 4 0"), ("name", "creative commons", "creative commons attribution non ?commercial share ?alike 4 0(?: international)?")),
    *_rules("cc-by-nc-nd-4.0", ("tag", "spdx", "spdx license identifier cc by nc nd 4 0"), ("link", "creativecommons", "creativecommons org licenses by nc nd 4 0"),
            ("name", "cc by", "cc by nc nd 4 0"), ("name", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?")),
    *_rules("cc-by-sa", ("name", "cc by", "cc by sa"), ("name", "creative commons", "creative commons attribution share ?alike")),
    *_rules("cc-by-nc", ("name", "cc by", "cc by nc"), ("name", "creative commons", "creative commons attribution non ?commercial")),
    *_rules("cc-by-nd", ("name", "cc by", "cc by nd"), ("name", "creative commons", "creative commons attribution no ?deriv(?:ative)?s")),
    *_rules("cc-by-nc-sa", ("name", "cc by", "cc by nc sa"), ("name", "creative commons", "creative commons attribution non ?commercial share ?alike")),
    *_rules("cc-by-nc-nd", ("name", "cc by", "cc by nc nd"), ("name", "creative commons", "creative commons attribution non ?commercial no ?deriv(?:ative)?s")),
    *_rules("cc-by-any", ("name", "cc by", "cc by"), ("name", "creative commons", "creative commons attribution(?: licen[cs]e)?")),
    *_rules("cc-any", ("link", "creativecommons", "creativecommons org licenses"), ("name", "creative commons", "creative commons licen[cs]e")),
    *_rules("public-domain", ("link", "creativecommons", "creativecommons org publicdomain mark 1 0"),
            ("grant", "public domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain"), ("grant", "public domain", "in the public domain")),
    # reserved rights and references without a known name
    *_rules("all-rights-reserved", ("grant", "rights reserved", "all rights reserved")),
    *_rules("proprietary", ("grant", "proprietary", "proprietary and confidential"), ("grant", "unauthorized", "unauthorized (?:copying|reproduction) of this file"),
            ("name", "proprietary", "proprietary licen[cs]e"), ("name", "licen", "commercial licen[cs]e"), ("name", "end user", "end user licen[cs]e agreement")),
    *_rules("unknown-license", ("any", "licen", "(?:released|licen[cs]ed|distributed|available|published) under the (?:terms of the )?(?:[0-9a-z]+ ){1,6}licen[cs]e"),
            ("any", "spdx", "spdx license identifier [0-9a-z]+(?: [0-9]+)*"), ("any", "licen", "see (?:the )?licen[cs]e (?:file )?for details"),
            ("any", "licen", "see the file licen[cs]e"), ("any", "licen", "licen[cs]e agreement")),
]
