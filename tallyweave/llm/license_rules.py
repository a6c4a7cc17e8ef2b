"""Signature rules for licenses, written by hand, most telling first.

A rule line is `label | keyword | pattern`. Texts are matched as lower-case
words of letters and digits with one space between them, so a pattern holds no
punctuation. A rule runs only on texts that have its keyword as a word, so the
keyword is a word of everything that the pattern matches.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# The phrases of the base, which always count.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Sentences from license texts and their notices.
SENTENCES = r"""
mit            | hereby      | permission is hereby granted free of charge to any person obtaining a copy of this software
mit            | sell        | to use copy modify merge publish distribute sublicense and or sell copies of the software
isc            | hereby      | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd           | hereby      | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-2          | redistributions | redistributions of source code must retain the above copyright notice this list of conditions
bsd-3          | endorse     | neither the name of (?:[a-z0-9]+ ){1,12}nor the names of its contributors may be used to endorse or promote
bsd-4          | advertising | all advertising materials mentioning features or use of this software must display
apache-2       | apache      | licensed under the apache license version 2 0 the license you may not use this file except in compliance
apache-2       | unless      | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-1-1     | apache         | this product includes software developed by the apache (?:software foundation|group)
gpl-2-plus     | redistribute | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3-plus     | redistribute | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl            | gnu         | you should have received a copy of the gnu general public license
lgpl-2-1-plus  | redistribute | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1
lgpl-3-plus    | redistribute | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3
lgpl           | gnu         | you should have received a copy of the gnu (?:lesser|library) general public license
agpl-3-plus    | affero      | gnu affero general public license as published by the free software foundation either version 3
agpl           | affero      | you should have received a copy of the gnu affero general public license
mpl-2          | mozilla     | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1-1        | mozilla     | the contents of this file are subject to the mozilla public license version 1 1
epl-2          | eclipse     | this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0
epl-1          | eclipse     | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
cddl-1         | development | the contents of this file are subject to the terms of the common development and distribution license
unlicense      | unencumbered | this is free and unencumbered software released into the public domain
wtfpl          | verbatim    | everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed
zlib           | altered     | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib           | implied     | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising
boost-1        | boost       | distributed under the boost software license version 1 0
boost-1        | hereby      | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
cc0-1          | deed        | the person who associated a work with this deed has dedicated the work to the public domain by waiving
cc0-1          | waived      | has waived all copyright and related or neighboring rights
artistic-2     | artistic    | the artistic license 2 0 copyright c 2000 2006 the perl foundation
ofl-1-1        | font        | this font software is licensed under the sil open font license version 1 1
ms-pl          | accompanying | this license governs use of the accompanying software if you use the software you accept this license
openssl        | openssl     | this product includes software developed by the openssl project
python-2       | python      | python software foundation license version 2
unicode        | unicode     | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files
curl           | permission  | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
ntp            | permission  | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee
gfdl-1-3       | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
gfdl           | documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
ecl-2          | educational | licensed under the educational community license version 2 0
eupl-1-2       | eupl        | licensed under the eupl version 1 2
postgresql     | documentation | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
ncsa           | deal        | to deal with the software without restriction
proprietary    | confidential | this (?:software|document|file) (?:is|contains) (?:the )?(?:confidential and proprietary|proprietary and confidential)
proprietary    | prohibited  | unauthorized (?:copying|reproduction|distribution|use) of this (?:file|software|document|work)(?: [a-z]+){0,6} is strictly prohibited
no-derivatives | adapt       | you may not adapt this (?:work|material)
no-derivatives | alter       | you may not alter this (?:work|material)
no-derivatives | transform   | you may not transform this (?:work|material)
no-derivatives | remix       | you may not remix this (?:work|material)
non-commercial | commercial  | (?:for|only for) non commercial (?:use|purposes)(?: only)?
non-commercial | noncommercial | (?:for|only for) noncommercial (?:use|purposes)(?: only)?
public-domain  | domain      | (?:is|are|been) (?:placed|released|dedicated)? ?(?:in|into|to) the public domain
"""

# Names of licenses, with versions.
NAMES = r"""
mit            | mit         | mit(?: x11)? licen[sc]e
mit            | expat       | expat licen[sc]e
mit-0          | mit         | mit no attribution(?: licen[sc]e)?
mit-advertising | mit        | mit licen[sc]e with advertising clause
x11            | x11         | x11 licen[sc]e
isc            | isc         | isc licen[sc]e
0bsd           | 0bsd        | 0bsd(?: licen[sc]e)?
0bsd           | zero        | (?:bsd zero clause|zero clause bsd)(?: licen[sc]e)?
bsd-1          | bsd         | (?:bsd 1 clause|1 clause bsd|one clause bsd)(?: licen[sc]e)?
bsd-2          | bsd         | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd)(?: licen[sc]e)?
bsd-2          | freebsd     | freebsd(?: licen[sc]e)?
bsd-3          | bsd         | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
bsd-3-clear    | clear       | (?:bsd 3 clause clear|clear bsd)(?: licen[sc]e)?
bsd-4          | bsd         | (?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: licen[sc]e)?
bsd-patent     | patent      | bsd 2 clause plus patent(?: licen[sc]e)?
bsd            | bsd         | bsd(?: style)? licen[sc]e
apache-1       | apache      | apache (?:software )?licen[sc]e(?: version | v ?| )1 0
apache-1-1     | apache      | apache (?:software )?licen[sc]e(?: version | v ?| )1 1
apache-2       | apache      | apache (?:software )?licen[sc]e(?: version | v ?| )2(?: 0)?
apache-2       | apache      | apache (?:software )?licen[sc]e v2(?: 0)?
apache-2       | apache      | apache 2(?: 0)?(?: licen[sc]e)?
apache         | apache      | apache (?:software )?licen[sc]e
gpl-1          | gnu         | gnu general public licen[sc]e(?: version | v ?| )1(?: 0)?
gpl-2          | gnu         | gnu general public licen[sc]e(?: version | v ?| )2(?: 0)?
gpl-3          | gnu         | gnu general public licen[sc]e(?: version | v ?| )3(?: 0)?
gpl-2          | gpl         | (?:gnu )?gpl(?: version | v ?| )2(?: 0)?
gpl-3          | gpl         | (?:gnu )?gpl(?: version | v ?| )3(?: 0)?
gpl-2          | gplv2       | (?:gnu )?gplv2
gpl-3          | gplv3       | (?:gnu )?gplv3
gpl            | gpl         | (?:gnu )?gpl(?: licen[sc]e)?
gpl            | gnu         | gnu general public licen[sc]e
gpl-classpath  | classpath   | (?:gpl|gnu general public licen[sc]e)(?: version | v ?| )?2?(?: 0)? with(?: the)? classpath exception
gpl-linking    | exception   | (?:gpl|gnu general public licen[sc]e)(?: [0-9v]+){0,3} with(?: a)? linking exception
lgpl-2         | library     | gnu library general public licen[sc]e(?: version | v ?| )2(?: 0)?
lgpl-2-1       | lesser      | gnu lesser general public licen[sc]e(?: version | v ?| )2 1
lgpl-3         | lesser      | gnu lesser general public licen[sc]e(?: version | v ?| )3(?: 0)?
lgpl           | lesser      | (?:gnu )?lesser general public licen[sc]e
lgpl           | library     | (?:gnu )?library general public licen[sc]e
lgpl-2-1       | lgpl        | (?:gnu )?lgpl(?: version | v ?| )2 1
lgpl-3         | lgpl        | (?:gnu )?lgpl(?: version | v ?| )3(?: 0)?
lgpl-3         | lgplv3      | (?:gnu )?lgplv3
lgpl           | lgpl        | (?:gnu )?lgpl(?: licen[sc]e)?
agpl-1         | affero      | affero general public licen[sc]e(?: version | v ?| )1(?: 0)?
agpl-3         | affero      | (?:gnu )?affero general public licen[sc]e(?: version | v ?| )3(?: 0)?
agpl           | affero      | (?:gnu )?affero general public licen[sc]e
agpl-3         | agpl        | (?:gnu )?agpl(?: version | v ?| )3(?: 0)?
agpl-3         | agplv3      | (?:gnu )?agplv3
agpl           | agpl        | (?:gnu )?agpl(?: licen[sc]e)?
gfdl-1-1       | documentation | gnu free documentation licen[sc]e(?: version | v ?| )1 1
gfdl-1-2       | documentation | gnu free documentation licen[sc]e(?: version | v ?| )1 2
gfdl-1-3       | documentation | gnu free documentation licen[sc]e(?: version | v ?| )1 3
gfdl           | documentation | (?:gnu )?free documentation licen[sc]e
mpl-1          | mozilla     | mozilla public licen[sc]e(?: version | v ?| )1 0
mpl-1-1        | mozilla     | mozilla public licen[sc]e(?: version | v ?| )1 1
mpl-2          | mozilla     | mozilla public licen[sc]e(?: version | v ?| )2(?: 0)?
mpl            | mozilla     | mozilla public licen[sc]e
mpl-2          | mpl         | mpl(?: version | v ?| )2(?: 0)?
epl-1          | eclipse     | eclipse public licen[sc]e(?: version | v ?| )1(?: 0)?
epl-2          | eclipse     | eclipse public licen[sc]e(?: version | v ?| )2(?: 0)?
epl            | eclipse     | eclipse public licen[sc]e
edl-1          | eclipse     | eclipse distribution licen[sc]e(?: version | v ?| )1(?: 0)?
cddl-1         | cddl        | cddl(?: version | v ?| )1 0
cddl-1-1       | cddl        | cddl(?: version | v ?| )1 1
cddl           | cddl        | cddl
cddl           | development | common development and distribution licen[sc]e
cpl-1          | common      | common public licen[sc]e(?: version | v ?| )1 0
cpal-1         | attribution | common public attribution licen[sc]e(?: version | v ?| )1 0
ipl-1          | ibm         | ibm public licen[sc]e(?: version | v ?| )1 0
spl-1          | sun         | sun public licen[sc]e(?: version | v ?| )1 0
npl-1-1        | netscape    | netscape public licen[sc]e(?: version | v ?| )1 1
qpl-1          | public      | q public licen[sc]e(?: version | v ?| )1 0
apsl-2         | apple       | apple public source licen[sc]e(?: version | v ?| )2(?: 0)?
apsl           | apple       | apple public source licen[sc]e
ms-pl          | microsoft   | microsoft public licen[sc]e
ms-rl          | microsoft   | microsoft reciprocal licen[sc]e
eupl-1-1       | union       | european union public licen[sc]e(?: version | v ?| )1 1
eupl-1-2       | union       | european union public licen[sc]e(?: version | v ?| )1 2
eupl           | union       | european union public licen[sc]e
osl-3          | open        | open software licen[sc]e(?: version | v ?| )3(?: 0)?
afl-3          | academic    | academic free licen[sc]e(?: version | v ?| )3(?: 0)?
afl-2-1        | academic    | academic free licen[sc]e(?: version | v ?| )2 1
artistic-1     | artistic    | artistic licen[sc]e(?: version | v ?| )1(?: 0)?
artistic-2     | artistic    | artistic licen[sc]e(?: version | v ?| )2(?: 0)?
artistic       | artistic    | artistic licen[sc]e
perl           | perl        | (?:under the )?same terms as perl(?: itself)?
boost-1        | boost       | boost software licen[sc]e(?: version | v ?| )1(?: 0)?
boost          | boost       | boost (?:software )?licen[sc]e
zlib           | zlib        | zlib(?: libpng)? licen[sc]e
libpng         | libpng      | libpng licen[sc]e
libpng         | png         | png reference library licen[sc]e
bzip2          | bzip2       | bzip2 licen[sc]e
curl           | curl        | curl licen[sc]e
openssl        | openssl     | openssl licen[sc]e
ssleay         | ssleay      | ssleay licen[sc]e
php-3          | php         | php licen[sc]e(?: version | v ?| )3(?: 0| 01)?
zpl-2-1        | zope        | zope public licen[sc]e(?: version | v ?| )2 1
zpl-2          | zope        | zope public licen[sc]e(?: version | v ?| )2 0
ruby           | ruby        | ruby licen[sc]e
vim            | vim         | vim licen[sc]e
tcl            | tcl         | tcl tk licen[sc]e
python-2       | psf         | psf licen[sc]e(?: version | v ?| )2(?: 0)?
python         | python      | python software foundation licen[sc]e
postgresql     | postgresql  | postgresql licen[sc]e
ncsa           | ncsa        | (?:university of illinois )?ncsa(?: open source)? licen[sc]e
w3c            | w3c         | w3c software(?: notice)?(?: and)? licen[sc]e
unicode        | unicode     | unicode(?: dfs 2015| dfs 2016)? licen[sc]e(?: agreement)?
unlicense      | unlicense   | (?:the )?unlicense
wtfpl          | wtfpl       | wtfpl(?: version| v)?(?: 2)?
beerware       | beerware    | beerware(?: licen[sc]e)?
beerware       | beer        | beer ware licen[sc]e
json           | json        | json licen[sc]e
cecill-2-1     | cecill      | cecill(?: version | v ?| )2 1
cecill-b       | cecill      | cecill b
cecill-c       | cecill      | cecill c
cecill         | cecill      | cecill(?: licen[sc]e)?
mulan-2        | mulan       | mulan (?:psl|permissive software licen[sc]e)(?: version | v ?| )?2
ecl-2          | educational | educational community licen[sc]e(?: version | v ?| )2(?: 0)?
upl-1          | universal   | universal permissive licen[sc]e(?: version | v ?| )1(?: 0)?
ofl-1-1        | font        | (?:sil )?open font licen[sc]e(?: version | v ?| )1 1
ofl            | font        | (?:sil )?open font licen[sc]e
ofl            | ofl         | sil ofl
lppl-1-3       | latex       | latex project public licen[sc]e(?: version | v ?| )1 3
odbl-1         | database    | open (?:data commons open )?database licen[sc]e(?: version | v ?| )?1?(?: 0)?
odbl-1         | odbl        | odbl(?: 1 0)?
odc-by-1       | commons     | open data commons attribution licen[sc]e
pddl-1         | commons     | open data commons public domain dedication(?: and licen[sc]e)?
ogl-3          | government  | open government licen[sc]e(?: version | v ?| )?3?(?: 0)?
cdla-permissive | community  | community data licen[sc]e agreement permissive
cdla-sharing   | community   | community data licen[sc]e agreement sharing
openrail-m     | openrail    | (?:bigscience )?openrail m?(?: licen[sc]e)?
rail           | responsible | responsible ai licen[sc]e
busl-1-1       | business    | business source licen[sc]e(?: version | v ?| )1 1
sspl-1         | server      | server side public licen[sc]e(?: version | v ?| )?1?
elastic-2      | elastic     | elastic licen[sc]e(?: version | v ?| )2(?: 0)?
commons-clause | clause      | commons clause
polyform-nc    | polyform    | polyform noncommercial licen[sc]e
polyform-sb    | polyform    | polyform small business licen[sc]e
cc0-1          | cc0         | (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0-1          | zero        | creative commons zero(?: v1 0| 1 0)?
cc-pdm         | mark        | (?:creative commons )?public domain mark(?: 1 0)?
cc-by-nc-nd    | cc          | cc by nc nd
cc-by-nc-sa    | cc          | cc by nc sa
cc-by-nc       | cc          | cc by nc
cc-by-nd       | cc          | cc by nd
cc-by-sa       | cc          | cc by sa
cc-by          | cc          | cc by
cc-by-nc-nd    | commons     | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?
cc-by-nc-sa    | commons     | creative commons attribution non ?commercial share ?alike
cc-by-nc       | commons     | creative commons attribution non ?commercial
cc-by-nd       | commons     | creative commons attribution no ?deriv(?:ative)?s?(?: works)?
cc-by-sa       | commons     | creative commons attribution share ?alike
cc-by          | commons     | creative commons attribution
creative-commons | commons   | creative commons licen[sc]e
public-domain  | domain      | public domain dedication
all-rights-reserved | reserved | all rights reserved
all-rights-reserved | droits | tous droits r[^ ]{1,2}serv[^ ]{1,2}s
all-rights-reserved | reservados | todos los derechos reservados
all-rights-reserved | vorbehalten | alle rechte vorbehalten
"""

# Identifiers after an SPDX tag; the words of the tag and the id.
IDENTIFIERS = r"""
mit            | mit
isc            | isc
0bsd           | 0bsd
bsd-2          | bsd 2 clause
bsd-3          | bsd 3 clause
bsd-4          | bsd 4 clause
apache-1-1     | apache 1 1
apache-2       | apache 2 0
gpl-1-only     | gpl 1 0 only
gpl-2-only     | gpl 2 0 only
gpl-2-plus     | gpl 2 0 or later
gpl-2          | gpl 2 0
gpl-3-only     | gpl 3 0 only
gpl-3-plus     | gpl 3 0 or later
gpl-3          | gpl 3 0
lgpl-2-only    | lgpl 2 0 only
lgpl-2-1-only  | lgpl 2 1 only
lgpl-2-1-plus  | lgpl 2 1 or later
lgpl-2-1       | lgpl 2 1
lgpl-3-only    | lgpl 3 0 only
lgpl-3-plus    | lgpl 3 0 or later
lgpl-3         | lgpl 3 0
agpl-3-only    | agpl 3 0 only
agpl-3-plus    | agpl 3 0 or later
agpl-3         | agpl 3 0
mpl-1-1        | mpl 1 1
mpl-2          | mpl 2 0
epl-1          | epl 1 0
epl-2          | epl 2 0
cddl-1         | cddl 1 0
artistic-2     | artistic 2 0
boost-1        | bsl 1 0
zlib           | zlib
unlicense      | unlicense
wtfpl          | wtfpl
cc0-1          | cc0 1 0
cc-by-3        | cc by 3 0
cc-by-4        | cc by 4 0
cc-by-sa-3     | cc by sa 3 0
cc-by-sa-4     | cc by sa 4 0
cc-by-nc-4     | cc by nc 4 0
cc-by-nd-4     | cc by nd 4 0
cc-by-nc-sa-4  | cc by nc sa 4 0
cc-by-nc-nd-4  | cc by nc nd 4 0
ofl-1-1        | ofl 1 1
postgresql     | postgresql
python-2       | psf 2 0
ncsa           | ncsa
ms-pl          | ms pl
ms-rl          | ms rl
eupl-1-2       | eupl 1 2
upl-1          | upl 1 0
busl-1-1       | busl 1 1
odbl-1         | odbl 1 0
"""

# What stands before a name where the license is granted and not only named.
GRANT = (
    r"(?:(?:re)?licen[sc]ed|released|distributed|available|published|provided|covered|subject)"
    r"(?: (?:un)?der| to)?(?: the terms(?: and conditions)? of)?(?: the| a| an)? "
)


@dataclass(frozen=True)
class Rule:
    """Lower priority numbers win; `confidence` is what a hit is worth."""

    label: str
    keyword: bytes
    pattern: re.Pattern
    priority: int
    confidence: float


def _lines(table: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" | ", 2)] for line in table.strip().splitlines()]


def _rule(label: str, keyword: str, pattern: str, priority: int, confidence: float) -> Rule:
    words = re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode())
    return Rule(label, keyword.encode(), words, priority, confidence)


def rules() -> list[Rule]:
    """All rules in the order of their priority."""
    out = [_rule(label, phrase.split()[0], phrase, 0, 1.0) for phrase, label in BASE.items()]
    out += [
        _rule(label, "spdx", rf"spdx licen[sc]e identifier {name}", 1, 0.99)
        for label, name in _lines(IDENTIFIERS)
    ]
    out += [_rule(*line, 2, 0.95) for line in _lines(SENTENCES)]
    names = _lines(NAMES)
    out += [_rule(label, word, GRANT + f"(?:{name})", 3, 0.9) for label, word, name in names]
    out += [_rule(label, word, name, 4, 0.6) for label, word, name in names]
    return out
