"""Signature rules of op 11, written by hand.

A rule is read as ``label | kind | keyword | pattern``.  Patterns are regular expressions over normalised text: words
in lower case, one blank between two, so "GPL-2.0" is ``gpl 2 0``.  They start and end at words.  ``keyword`` is a
word or words that every match of the pattern holds; a text without it isn't searched for the pattern.  ``{lic}``
stands for licence or license, ``{by}`` for the ways to say that terms hold, ``{v}`` for a word that leads a version.

Kinds, the highest priority first: ``notice`` (sentences of the licence or its header), ``tag`` (machine-readable),
``grant`` (a statement that terms hold), ``url``, ``name`` (full name with version), ``mention`` (a name alone).
"""

from __future__ import annotations

MACROS = {"{lic}": "licen[cs]es?", "{by}": "(?:licensed|released|available|distributed|provided|published|covered) (?:under|by)"
                                          "(?: the)?(?: terms of)?(?: the)?", "{v}": "(?:v|ver|version)"}

RULES = r"""
apache-2.0 | notice | apache | licensed under the apache {lic} {v} 2 0
apache-2.0 | notice | you may not use this file except | you may not use this file except in compliance with the {lic}
apache-2.0 | notice | without warranties or conditions | on an as is basis without warranties or conditions of any kind
apache-2.0 | notice | grant of patent license | grant of patent license subject to the terms and conditions of this license
apache-2.0 | tag | apache | spdx {lic} identifier apache 2 0
apache-2.0 | grant | apache | {by} apache(?: software)?(?: {lic})?(?: {v})? 2(?: 0)?
apache-2.0 | url | apache | (?:www )?apache org {lic} {lic} 2 0
apache-2.0 | name | apache | apache(?: software)? {lic} (?:{v} )?2(?: 0)?
apache-2.0 | name | asl | asl 2 0
apache-2.0 | mention | apache | apache 2 0
apache-1.1 | notice | apache software foundation | this product includes software developed by the apache software foundation
apache-1.1 | tag | apache | spdx {lic} identifier apache 1 1
apache-1.1 | name | apache | apache(?: software)? {lic} (?:{v} )?1 1
apache-1.0 | tag | apache | spdx {lic} identifier apache 1 0
apache-1.0 | name | apache | apache(?: software)? {lic} (?:{v} )?1 0
mit | notice | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy
mit | notice | sublicense and or sell | use copy modify merge publish distribute sublicense and or sell copies
mit | notice | substantial portions | shall be included in all copies or substantial portions of the software
mit | tag | mit | spdx {lic} identifier mit
mit | grant | mit | {by} mit(?: x11)?(?: {lic})?
mit | url | mit | opensource org {lic} mit(?: {lic})?(?: php)?
mit | name | mit | mit x11 {lic}
mit | name | expat | expat {lic}
mit | mention | mit | mit style {lic}
mit-0 | tag | mit | spdx {lic} identifier mit 0
mit-0 | name | mit | mit no attribution(?: {lic})?
x11 | tag | x11 | spdx {lic} identifier x11
x11 | name | x11 | x11 {lic}
gpl-1.0 | name | gnu | gnu general public {lic} (?:{v} )?1(?: 0)?
gpl-1.0 | tag | gpl | spdx {lic} identifier gpl 1 0(?: only| or later)?
gpl-2.0 | notice | free software foundation | as published by the free software foundation either {v} 2 of the {lic}
gpl-2.0 | notice | gnu general public license version 2 | under the terms of the gnu general public license version 2
gpl-2.0 | tag | gpl | spdx {lic} identifier gpl 2 0(?: only| or later)?
gpl-2.0 | grant | gpl | {by} (?:gnu )?gpl ?(?:{v} ?)?2(?: 0)?
gpl-2.0 | grant | gplv2 | {by} (?:gnu )?gplv2
gpl-2.0 | url | gnu | (?:www )?gnu org {lic} (?:old {lic} )?gpl 2 0
gpl-2.0 | name | gnu | gnu general public {lic} (?:{v} )?2(?: 0)?
gpl-2.0 | name | gplv2 | gplv2
gpl-2.0 | name | gpl | gpl 2 0(?: only| or later)?
gpl-2.0 | mention | gpl | gpl {v} 2
gpl-3.0 | notice | free software foundation | as published by the free software foundation either {v} 3 of the {lic}
gpl-3.0 | notice | gnu | this (?:work|program|software|library) is licensed under the gnu general public {lic} {v} 3
gpl-3.0 | tag | gpl | spdx {lic} identifier gpl 3 0(?: only| or later)?
gpl-3.0 | grant | gpl | {by} (?:gnu )?gpl ?(?:{v} ?)?3(?: 0)?
gpl-3.0 | grant | gplv3 | {by} (?:gnu )?gplv3
gpl-3.0 | url | gnu | (?:www )?gnu org {lic} gpl 3 0
gpl-3.0 | name | gnu | gnu general public {lic} (?:{v} )?3(?: 0)?
gpl-3.0 | name | gplv3 | gplv3
gpl-3.0 | name | gpl | gpl 3 0(?: only| or later)?
gpl-3.0 | mention | gpl | gpl {v} 3
gpl | notice | see the gnu general public license | see the gnu general public license for more details
gpl | notice | received a copy of the gnu general | you should have received a copy of the gnu general public license
gpl | grant | gpl | {by} (?:gnu )?gpl
gpl | url | gnu | (?:www )?gnu org {lic} gpl
gpl | mention | gpl | gnu gpl
lgpl-2.0 | tag | lgpl | spdx {lic} identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | name | gnu | gnu (?:library|lesser) general public {lic} (?:{v} )?2(?: 0)?
lgpl-2.1 | notice | lesser general public | terms of the gnu lesser general public {lic} as published by the free software foundation either {v} 2 1
lgpl-2.1 | tag | lgpl | spdx {lic} identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | grant | lgpl | {by} (?:gnu )?lgpl ?(?:{v} ?)?2 1
lgpl-2.1 | name | gnu | gnu lesser general public {lic} (?:{v} )?2 1
lgpl-2.1 | name | lgpl | lgpl (?:{v} )?2 1
lgpl-3.0 | tag | lgpl | spdx {lic} identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | grant | lgpl | {by} (?:gnu )?lgpl ?(?:{v} ?)?3(?: 0)?
lgpl-3.0 | name | gnu | gnu lesser general public {lic} (?:{v} )?3(?: 0)?
lgpl-3.0 | name | lgplv3 | lgplv3
lgpl | notice | see the gnu lesser | see the gnu lesser general public license for more details
lgpl | name | gnu | gnu (?:lesser|library) general public {lic}
lgpl | mention | lgpl | gnu lgpl
agpl-3.0 | notice | affero general public | terms of the gnu affero general public {lic} as published by the free software foundation
agpl-3.0 | tag | agpl | spdx {lic} identifier agpl 3 0(?: only| or later)?
agpl-3.0 | grant | agpl | {by} (?:gnu )?agpl ?(?:{v} ?)?3(?: 0)?
agpl-3.0 | url | agpl | (?:www )?gnu org {lic} agpl 3 0
agpl-3.0 | name | affero | gnu affero general public {lic} (?:{v} )?3(?: 0)?
agpl-3.0 | name | agplv3 | agplv3
agpl | name | affero | (?:gnu )?affero general public {lic}
agpl | mention | agpl | gnu agpl
gfdl-1.1 | tag | gfdl | spdx {lic} identifier gfdl 1 1(?: only| or later)?
gfdl-1.2 | tag | gfdl | spdx {lic} identifier gfdl 1 2(?: only| or later)?
gfdl-1.2 | name | gnu | gnu free documentation {lic} {v} 1 2
gfdl-1.3 | notice | gnu | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation {lic}
gfdl-1.3 | tag | gfdl | spdx {lic} identifier gfdl 1 3(?: only| or later)?
gfdl-1.3 | name | gnu | gnu free documentation {lic} {v} 1 3
gfdl | name | gnu | gnu free documentation {lic}
bsd | notice | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd | notice | copyright holders and contributors | this software is provided by the copyright holders and contributors as is
bsd-3-clause | notice | endorse or promote products | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause | tag | bsd | spdx {lic} identifier bsd 3 clause
bsd-3-clause | grant | bsd | {by} bsd 3 clause(?: {lic})?
bsd-3-clause | url | bsd | opensource org {lic} bsd 3 clause
bsd-3-clause | name | bsd | (?:3|three) clause bsd {lic}
bsd-3-clause | name | bsd | bsd 3 clause(?: {lic})?
bsd-3-clause | name | bsd | (?:new|modified|revised) bsd {lic}
bsd-2-clause | tag | bsd | spdx {lic} identifier bsd 2 clause
bsd-2-clause | grant | bsd | {by} bsd 2 clause(?: {lic})?
bsd-2-clause | url | bsd | opensource org {lic} bsd 2 clause
bsd-2-clause | name | bsd | (?:2|two) clause bsd {lic}
bsd-2-clause | name | bsd | bsd 2 clause(?: {lic})?
bsd-2-clause | name | bsd | (?:simplified|freebsd) bsd {lic}
bsd-4-clause | notice | advertising materials mentioning | all advertising materials mentioning features or use of this software must display
bsd-4-clause | tag | bsd | spdx {lic} identifier bsd 4 clause
bsd-4-clause | name | bsd | (?:(?:4|four) clause|original) bsd {lic}
0bsd | tag | 0bsd | spdx {lic} identifier 0bsd
0bsd | name | bsd | (?:zero|0) clause bsd(?: {lic})?
bsd | grant | bsd | {by} bsd(?: style)? {lic}
bsd | mention | bsd | bsd(?: style)? {lic}
isc | notice | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | tag | isc | spdx {lic} identifier isc
isc | grant | isc | {by} isc(?: {lic})?
isc | url | isc | opensource org {lic} isc(?: {lic})?
isc | mention | isc | isc {lic}
mpl-1.0 | tag | mpl | spdx {lic} identifier mpl 1 0
mpl-1.1 | tag | mpl | spdx {lic} identifier mpl 1 1
mpl-1.1 | name | mozilla | mozilla public {lic} (?:{v} )?1 1
mpl-2.0 | notice | mozilla | this source code form is subject to the terms of the mozilla public {lic}
mpl-2.0 | tag | mpl | spdx {lic} identifier mpl 2 0
mpl-2.0 | grant | mpl | {by} mpl (?:{v} )?2 0
mpl-2.0 | url | mozilla | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-2.0 | name | mozilla | mozilla public {lic} (?:{v} )?2(?: 0)?
mpl | mention | mozilla | mozilla public {lic}
epl-1.0 | notice | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public {lic} {v} 1 0
epl-1.0 | tag | epl | spdx {lic} identifier epl 1 0
epl-1.0 | name | eclipse | eclipse public {lic} (?:{v} )?1(?: 0)?
epl-2.0 | notice | eclipse | this program and the accompanying materials are made available under the terms of the eclipse public {lic} {v} 2 0
epl-2.0 | tag | epl | spdx {lic} identifier epl 2 0
epl-2.0 | url | eclipse | (?:www )?eclipse org legal epl (?:2 0|v20)
epl-2.0 | name | eclipse | eclipse public {lic} (?:{v} )?2(?: 0)?
epl | mention | eclipse | eclipse public {lic}
edl-1.0 | name | eclipse | eclipse distribution {lic}(?: {v})? 1 0
cddl-1.0 | notice | common development and distribution | the contents of this file are subject to the terms of the common development and distribution {lic}
cddl-1.0 | tag | cddl | spdx {lic} identifier cddl 1 0
cddl-1.0 | name | common development and distribution | common development and distribution {lic} (?:cddl )?(?:{v} )?1 0
cddl-1.1 | tag | cddl | spdx {lic} identifier cddl 1 1
cddl-1.1 | name | common development and distribution | common development and distribution {lic} (?:cddl )?(?:{v} )?1 1
cddl | mention | common development and distribution | common development and distribution {lic}
cpl-1.0 | tag | cpl | spdx {lic} identifier cpl 1 0
cpl-1.0 | name | common public | common public {lic} (?:{v} )?1 0
ipl-1.0 | name | ibm | ibm public {lic} (?:{v} )?1 0
cc0-1.0 | notice | cc0 | to the extent possible under law .{0,80}? has waived all copyright(?: and related or neighboring rights)?(?: .{0,80}?)? cc0
cc0-1.0 | tag | cc0 | spdx {lic} identifier cc0 1 0
cc0-1.0 | grant | cc0 | {by} (?:creative commons )?cc0(?: 1 0)?
cc0-1.0 | url | creativecommons | creativecommons org publicdomain zero 1 0
cc0-1.0 | name | creative commons | creative commons (?:zero|cc0)(?: (?:{v} )?1 0)?
cc0-1.0 | name | cc0 | cc0 1 0 universal
cc-by-1.0 | tag | cc | spdx {lic} identifier cc by 1 0
cc-by-2.0 | tag | cc | spdx {lic} identifier cc by 2 0
cc-by-2.0 | url | creativecommons | creativecommons org {lic} by 2 0
cc-by-2.5 | tag | cc | spdx {lic} identifier cc by 2 5
cc-by-2.5 | url | creativecommons | creativecommons org {lic} by 2 5
cc-by-3.0 | tag | cc | spdx {lic} identifier cc by 3 0
cc-by-3.0 | grant | cc by | {by} cc by 3 0
cc-by-3.0 | url | creativecommons | creativecommons org {lic} by 3 0
cc-by-3.0 | name | creative commons | creative commons attribution 3 0(?: unported| international)?(?: {lic})?
cc-by-4.0 | notice | creative commons | this (?:work|article|document|page) is licensed under (?:a|the) creative commons attribution 4 0 international {lic}
cc-by-4.0 | tag | cc | spdx {lic} identifier cc by 4 0
cc-by-4.0 | grant | cc by | {by} cc by 4 0
cc-by-4.0 | url | creativecommons | creativecommons org {lic} by 4 0
cc-by-4.0 | name | creative commons | creative commons attribution 4 0(?: international)?(?: {lic})?
cc-by-4.0 | name | cc by | cc by 4 0
cc-by | grant | cc by | {by} cc by
cc-by | name | creative commons | creative commons attribution {lic}
cc-by-sa-2.0 | url | creativecommons | creativecommons org {lic} by sa 2 0
cc-by-sa-2.5 | url | creativecommons | creativecommons org {lic} by sa 2 5
cc-by-sa-3.0 | notice | creative commons | text is available under the creative commons attribution share ?alike(?: 3 0)? {lic}
cc-by-sa-3.0 | tag | cc | spdx {lic} identifier cc by sa 3 0
cc-by-sa-3.0 | url | creativecommons | creativecommons org {lic} by sa 3 0
cc-by-sa-3.0 | name | creative commons | creative commons attribution share ?alike 3 0(?: unported)?(?: {lic})?
cc-by-sa-4.0 | tag | cc | spdx {lic} identifier cc by sa 4 0
cc-by-sa-4.0 | grant | cc by sa | {by} cc by sa 4 0
cc-by-sa-4.0 | url | creativecommons | creativecommons org {lic} by sa 4 0
cc-by-sa-4.0 | name | creative commons | creative commons attribution share ?alike 4 0(?: international)?(?: {lic})?
cc-by-sa-4.0 | name | cc by sa | cc by sa 4 0
cc-by-sa | grant | cc by sa | {by} cc by sa
cc-by-sa | mention | cc by sa | cc by sa
cc-by-nc-3.0 | url | creativecommons | creativecommons org {lic} by nc 3 0
cc-by-nc-4.0 | tag | cc | spdx {lic} identifier cc by nc 4 0
cc-by-nc-4.0 | url | creativecommons | creativecommons org {lic} by nc 4 0
cc-by-nc-4.0 | name | creative commons | creative commons attribution non ?commercial 4 0(?: international)?(?: {lic})?
cc-by-nc-4.0 | name | cc by nc | cc by nc 4 0
cc-by-nc | grant | cc by nc | {by} cc by nc
cc-by-nc | name | creative commons | creative commons attribution non ?commercial {lic}
cc-by-nc | mention | cc by nc | cc by nc
cc-by-nc-sa-3.0 | url | creativecommons | creativecommons org {lic} by nc sa 3 0
cc-by-nc-sa-4.0 | tag | cc | spdx {lic} identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 | url | creativecommons | creativecommons org {lic} by nc sa 4 0
cc-by-nc-sa-4.0 | name | cc by nc sa | cc by nc sa 4 0
cc-by-nc-sa | grant | cc by nc sa | {by} cc by nc sa
cc-by-nc-sa | mention | cc by nc sa | cc by nc sa
cc-by-nc-nd-4.0 | tag | cc | spdx {lic} identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 | url | creativecommons | creativecommons org {lic} by nc nd 4 0
cc-by-nc-nd-4.0 | name | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: {lic})?
cc-by-nc-nd | grant | cc by nc nd | {by} cc by nc nd
cc-by-nc-nd | mention | cc by nc nd | cc by nc nd
cc-by-nd-4.0 | tag | cc | spdx {lic} identifier cc by nd 4 0
cc-by-nd-4.0 | url | creativecommons | creativecommons org {lic} by nd 4 0
cc-by-nd | mention | cc by nd | cc by nd
creative-commons | mention | creative commons | creative commons {lic}
unlicense | notice | unencumbered | this is free and unencumbered software released into the public domain
unlicense | tag | unlicense | spdx {lic} identifier unlicense
unlicense | url | unlicense | (?:www )?unlicense org
unlicense | mention | unlicense | the unlicense
public-domain | notice | public domain | (?:dedicated|released|placed) (?:to|into|in) the public domain
wtfpl | notice | what the fuck you want | do what the fuck you want to public {lic}
wtfpl | tag | wtfpl | spdx {lic} identifier wtfpl
wtfpl | mention | wtfpl | wtfpl
zlib | notice | altered source versions | altered source versions must be plainly marked as such
zlib | tag | zlib | spdx {lic} identifier zlib
zlib | name | zlib | zlib libpng {lic}
zlib | mention | zlib | zlib {lic}
bsl-1.0 | notice | boost | distributed under the boost software {lic}(?: {v})? 1 0
bsl-1.0 | tag | bsl | spdx {lic} identifier bsl 1 0
bsl-1.0 | url | boost | (?:www )?boost org {lic} 1 0 txt
bsl-1.0 | name | boost | boost software {lic}(?: (?:{v} )?1 0)?
artistic-1.0 | tag | artistic | spdx {lic} identifier artistic 1 0
artistic-1.0 | name | artistic | artistic {lic} (?:{v} )?1 0
artistic-2.0 | tag | artistic | spdx {lic} identifier artistic 2 0
artistic-2.0 | name | artistic | artistic {lic} (?:{v} )?2 0
artistic | mention | artistic | artistic {lic}
python-2.0 | tag | python | spdx {lic} identifier (?:python|psf) 2 0
python-2.0 | name | python software foundation | python software foundation {lic}(?: {v} 2)?
postgresql | tag | postgresql | spdx {lic} identifier postgresql
postgresql | mention | postgresql | postgresql {lic}
php-3.01 | tag | php | spdx {lic} identifier php 3 01
php-3.01 | name | php | php {lic} {v} 3 01
ruby | notice | ruby | same terms as ruby(?: itself)?
openssl | notice | openssl | this product includes software developed by the openssl project
openssl | tag | openssl | spdx {lic} identifier openssl
openssl | mention | openssl | openssl {lic}
ofl-1.1 | notice | open font | this font software is licensed under the sil open font {lic}
ofl-1.1 | tag | ofl | spdx {lic} identifier ofl 1 1
ofl-1.1 | url | ofl | scripts sil org ofl
ofl-1.1 | name | open font | (?:sil )?open font {lic}(?: {v} 1 1)?
odbl-1.0 | tag | odbl | spdx {lic} identifier odbl 1 0
odbl-1.0 | url | opendatacommons | opendatacommons org {lic} odbl(?: 1 0)?
odbl-1.0 | name | open database | open database {lic}(?: odbl)?(?: {v} 1 0)?
odc-by-1.0 | url | opendatacommons | opendatacommons org {lic} by(?: 1 0)?
odc-by-1.0 | name | open data commons | open data commons attribution {lic}
pddl-1.0 | url | opendatacommons | opendatacommons org {lic} pddl(?: 1 0)?
pddl-1.0 | name | open data commons | open data commons public domain dedication and {lic}
eupl-1.1 | tag | eupl | spdx {lic} identifier eupl 1 1
eupl-1.2 | notice | eupl | licensed under the eupl(?: {v})? 1 2
eupl-1.2 | tag | eupl | spdx {lic} identifier eupl 1 2
eupl-1.2 | name | european union public | european union public {lic}(?: (?:{v} )?1 2)?
cecill-2.1 | tag | cecill | spdx {lic} identifier cecill 2 1
cecill | mention | cecill | cecill(?: [bc])? {lic}
ms-pl | tag | ms | spdx {lic} identifier ms pl
ms-pl | name | microsoft | microsoft public {lic}
ms-rl | name | microsoft | microsoft reciprocal {lic}
osl-3.0 | tag | osl | spdx {lic} identifier osl 3 0
osl-3.0 | name | open software | open software {lic} (?:{v} )?3 0
afl-3.0 | name | academic free | academic free {lic} (?:{v} )?3 0
afl | mention | academic free | academic free {lic}
qpl-1.0 | name | q public | q public {lic}(?: {v} 1 0)?
sspl-1.0 | tag | sspl | spdx {lic} identifier sspl 1 0
sspl-1.0 | name | server side public | server side public {lic}(?: (?:{v} )?1)?
busl-1.1 | tag | busl | spdx {lic} identifier busl 1 1
busl-1.1 | name | business source | business source {lic}(?: (?:{v} )?1 1)?
elastic-2.0 | name | elastic | elastic {lic} (?:{v} )?2 0
commons-clause | name | commons clause | commons clause {lic} condition(?: {v} 1 0)?
upl-1.0 | name | universal permissive | universal permissive {lic}(?: (?:{v} )?1 0)?
ncsa | name | ncsa | (?:university of illinois )?ncsa open source {lic}
unicode | name | unicode | unicode {lic}(?: v3)?
vim | name | vim | vim {lic}
w3c | notice | w3c | w3c software (?:notice and|and document) {lic}
openrail-m | name | openrail | (?:creativeml |bigscience )?openrail m(?: {lic})?
rail-1.0 | name | bigscience | bigscience (?:bloom )?rail {lic}(?: (?:{v} )?1 0)?
llama-community | name | community license agreement | llama [0-9](?: [0-9])? community license agreement
proprietary | notice | all rights reserved | all rights reserved no part of this (?:publication|book|work|document) may be reproduced
proprietary | notice | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
"""
