"""Signatures of licences: for each, hand-written patterns of its name, its identifiers and its addresses."""

from __future__ import annotations

import re
from dataclasses import dataclass

# Label | keywords, one of which is in every match, its white space taken as single blanks | patterns of the name | identifiers | address.
FAMILIES = r"""
mit | mit | (?:the )?mit(?:/x11)?(?: style)? licen[sc]e | mit | opensource\.org/licenses/mit
mit-0 | mit-0, no attribution | mit no attribution(?: licen[sc]e)? | mit-0 | opensource\.org/licenses/mit-0
apache-1.1 | apache | apache(?: software)? licen[sc]e,? (?:version |v)1\.1 | apache-1\.1 | apache\.org/licenses/license-1\.1
apache-2 | apache | apache(?: software)? licen[sc]e,? (?:version |v)?2(?:\.0)?; apache,? (?:version |v)?2(?:\.0)?(?: licen[sc]e)?; apache licen[sc]e | apache-2\.0 | apache\.org/licenses/license-2\.0
gpl-1 | gpl, general public | gnu general public licen[sc]e,? (?:version |v)1; gpl,? ?(?:version |v)1; version 1 of the gnu general public licen[sc]e | gpl-1\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0
gpl-2 | gpl, general public | gnu general public licen[sc]e,? (?:version |v)2; (?:gnu )?gpl,? ?(?:version |v)?2(?:\.0)?; version 2(?:\.0)? of the (?:gnu )?(?:general public licen[sc]e|gpl) | gpl-2\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0
gpl-3 | gpl, general public | gnu general public licen[sc]e,? (?:version |v)3; (?:gnu )?gpl,? ?(?:version |v)?3(?:\.0)?; version 3(?:\.0)? of the (?:gnu )?(?:general public licen[sc]e|gpl) | gpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/gpl-3\.0
gpl | gpl, general public | gnu general public licen[sc]e; gnu gpl | gpl | gnu\.org/licenses/gpl\.
lgpl-2 | lgpl, library general | gnu library general public licen[sc]e; lgpl ?v?2(?:\.0)? | lgpl-2\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/old-licenses/lgpl-2\.0
lgpl-2.1 | lgpl, lesser general | gnu lesser general public licen[sc]e,? (?:version |v)2\.1; lgpl,? ?(?:version |v)?2\.1; version 2\.1 of the (?:gnu )?(?:lesser general public licen[sc]e|lgpl) | lgpl-2\.1(?:-only|-or-later|\+)? | gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl-3 | lgpl, lesser general | gnu lesser general public licen[sc]e,? (?:version |v)3; lgpl,? ?(?:version |v)?3; version 3 of the (?:gnu )?(?:lesser general public licen[sc]e|lgpl) | lgpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/lgpl-3\.0
lgpl | lgpl, lesser general | gnu lesser general public licen[sc]e; gnu lgpl | lgpl | gnu\.org/licenses/lgpl\.
agpl-3 | agpl, affero | gnu affero general public licen[sc]e(?:,? (?:version |v)3)?; agpl,? ?(?:version |v)?3; version 3 of the (?:gnu )?affero general public licen[sc]e | agpl-3\.0(?:-only|-or-later|\+)? | gnu\.org/licenses/agpl
gfdl-1.3 | fdl, free documentation | gnu free documentation licen[sc]e(?:,? (?:version |v)1\.3)? | gfdl-1\.[123](?:-only|-or-later)? | gnu\.org/licenses/fdl
bsd-1 | bsd | (?:1|one)[- ]clause bsd licen[sc]e | bsd-1-clause | opensource\.org/license/bsd-1-clause
bsd-2 | bsd | (?:2|two)[- ]clause bsd licen[sc]e; bsd (?:2|two)[- ]clause(?: licen[sc]e)?; simplified bsd licen[sc]e; freebsd licen[sc]e | bsd-2-clause | opensource\.org/licenses/bsd-2-clause
bsd-3 | bsd | (?:3|three)[- ]clause bsd licen[sc]e; bsd (?:3|three)[- ]clause(?: licen[sc]e)?; (?:new|revised|modified) bsd licen[sc]e | bsd-3-clause | opensource\.org/licenses/bsd-3-clause
bsd-4 | bsd | (?:4|four)[- ]clause bsd licen[sc]e; bsd (?:4|four)[- ]clause(?: licen[sc]e)?; original bsd licen[sc]e | bsd-4-clause | spdx\.org/licenses/bsd-4-clause
bsd | bsd | bsd(?: style)? licen[sc]e | bsd | opensource\.org/licenses/bsd-license
0bsd | bsd | (?:zero|0)[- ]clause bsd(?: licen[sc]e)? | 0bsd | opensource\.org/licenses/0bsd
isc | isc | isc licen[sc]e | isc | opensource\.org/licenses/isc
mpl-1.1 | mpl, mozilla | mozilla public licen[sc]e,? (?:version |v)?1\.1; mpl ?v?1\.1 | mpl-1\.1 | mozilla\.org/mpl/1\.1
mpl-2 | mpl, mozilla | mozilla public licen[sc]e(?:,? (?:version |v)?2(?:\.0)?)?; mpl ?v?2(?:\.0)? | mpl-2\.0 | mozilla\.org/mpl/2\.0
epl-1 | epl, eclipse | eclipse public licen[sc]e,? (?:version |v)?1(?:\.0)? | epl-1\.0 | eclipse\.org/legal/epl-v10
epl-2 | epl, eclipse | eclipse public licen[sc]e(?:,? (?:version |v)?2(?:\.0)?)? | epl-2\.0 | eclipse\.org/legal/epl-2\.0
edl-1 | edl, eclipse | eclipse distribution licen[sc]e | edl-1\.0 | eclipse\.org/org/documents/edl
cddl-1 | cddl, common development | common development and distribution licen[sc]e | cddl-1\.[01] | opensource\.org/licenses/cddl
cpl-1 | cpl, common public | common public licen[sc]e | cpl-1\.0 | opensource\.org/licenses/cpl
ipl-1 | ipl, ibm public | ibm public licen[sc]e | ipl-1\.0 | opensource\.org/licenses/ipl
artistic-1 | artistic | artistic licen[sc]e,? (?:version |v)?1(?:\.0)? | artistic-1\.0 | opensource\.org/licenses/artistic-license-1
artistic-2 | artistic | artistic licen[sc]e(?:,? (?:version |v)?2(?:\.0)?)? | artistic-2\.0 | opensource\.org/licenses/artistic-license-2
zlib | zlib | zlib(?:/libpng)? licen[sc]e | zlib | opensource\.org/licenses/zlib
libpng | libpng | libpng licen[sc]e | libpng(?:-2\.0)? | libpng\.org/pub/png/src/libpng-license
bsl-1 | boost, bsl-1 | boost software licen[sc]e | bsl-1\.0 | boost\.org/license_1_0
unlicense | unlicense | the unlicense | unlicense | unlicense\.org
wtfpl | wtfpl, do what the | do what the f\S* you want to public licen[sc]e | wtfpl | wtfpl\.net
cc0 | cc0, creative commons zero, publicdomain/zero | cc0(?: 1\.0)?(?: universal)?; creative commons zero | cc0-1\.0 | creativecommons\.org/publicdomain/zero
cc-by | cc by, cc-by, creative commons, creativecommons | creative commons attribution(?: licen[sc]e)?(?: [1-4]\.0)?; cc[- ]by(?: [1-4]\.0) | cc-by-[1-4]\.[05] | creativecommons\.org/licenses/by/
cc-by-sa | by-sa, share alike, share-alike, sharealike, by sa | creative commons attribution[- ]share[- ]?alike; cc[- ]by[- ]sa(?: [1-4]\.0)? | cc-by-sa-[1-4]\.[05] | creativecommons\.org/licenses/by-sa
cc-by-nd | by-nd, no deriv, no-deriv, noderiv, by nd | creative commons attribution[- ]no[- ]?deriv\w*; cc[- ]by[- ]nd(?: [1-4]\.0)? | cc-by-nd-[1-4]\.[05] | creativecommons\.org/licenses/by-nd
cc-by-nc | by-nc, non commercial, non-commercial, noncommercial, by nc | creative commons attribution[- ]non[- ]?commercial; cc[- ]by[- ]nc(?: [1-4]\.0)? | cc-by-nc-[1-4]\.[05] | creativecommons\.org/licenses/by-nc/
cc-by-nc-sa | nc-sa, share alike, share-alike, sharealike, nc sa | creative commons attribution[- ]non[- ]?commercial[- ]share[- ]?alike; cc[- ]by[- ]nc[- ]sa(?: [1-4]\.0)? | cc-by-nc-sa-[1-4]\.[05] | creativecommons\.org/licenses/by-nc-sa
cc-by-nc-nd | nc-nd, no deriv, no-deriv, noderiv, nc nd | creative commons attribution[- ]non[- ]?commercial[- ]no[- ]?deriv\w*; cc[- ]by[- ]nc[- ]nd(?: [1-4]\.0)? | cc-by-nc-nd-[1-4]\.[05] | creativecommons\.org/licenses/by-nc-nd
public-domain | public domain, public-domain, publicdomain | (?:dedicated|released|placed) (?:in|in)to the public domain; public domain dedication | public-domain | creativecommons\.org/publicdomain/mark
odbl | odbl, open database | open database licen[sc]e | odbl-1\.0 | opendatacommons\.org/licenses/odbl
odc-by | odc, open data commons, opendatacommons | open data commons attribution licen[sc]e | odc-by-1\.0 | opendatacommons\.org/licenses/by
pddl | pddl, open data commons | open data commons public domain dedication | pddl-1\.0 | opendatacommons\.org/licenses/pddl
ofl-1.1 | ofl, open font | sil open font licen[sc]e; open font licen[sc]e | ofl-1\.[01] | scripts\.sil\.org/ofl
eupl-1.2 | eupl, european union public | european union public licen[sc]e | eupl-1\.[12] | joinup\.ec\.europa\.eu/\S*eupl
cecill-2.1 | cecill | cecill(?:-[bc])?(?: free software)? licen[sc]e | cecill-(?:[bc]|2\.[01]) | cecill\.info
python-2 | python, psf | python software foundation licen[sc]e; psf licen[sc]e | (?:python|psf)-2\.0 | python\.org/psf/license
php-3.01 | php | php licen[sc]e(?:,? (?:version |v)?3\.01)? | php-3\.01? | php\.net/license
ruby | ruby | ruby licen[sc]e | ruby | ruby-lang\.org/\S*license
perl | perl | same terms as perl(?: itself)?; perl licen[sc]e | perl | dev\.perl\.org/licenses
postgresql | postgresql | postgresql licen[sc]e | postgresql | postgresql\.org/about/licence
openssl | openssl | openssl licen[sc]e | openssl | openssl\.org/source/license
curl | curl | curl licen[sc]e | curl | curl\.(?:se|haxx\.se)/docs/copyright
x11 | x11, x consortium, x.org | x11 licen[sc]e; x consortium licen[sc]e | x11 | x\.org/\S*license
ncsa | ncsa, illinois | university of illinois/ncsa open source licen[sc]e; ncsa licen[sc]e | ncsa | opensource\.org/licenses/uoi-ncsa
upl-1 | upl, universal permissive | universal permissive licen[sc]e | upl-1\.0 | oss\.oracle\.com/licenses/upl
ms-pl | ms-pl, microsoft public | microsoft public licen[sc]e | ms-pl | opensource\.org/licenses/ms-pl
ms-rl | ms-rl, microsoft reciprocal | microsoft reciprocal licen[sc]e | ms-rl | opensource\.org/licenses/ms-rl
afl-3 | afl, academic free | academic free licen[sc]e(?:,? (?:version |v)?3(?:\.0)?)? | afl-[123]\.[01] | opensource\.org/licenses/afl
osl-3 | osl, open software licen | open software licen[sc]e(?:,? (?:version |v)?3(?:\.0)?)? | osl-[123]\.[01] | opensource\.org/licenses/osl
ecl-2 | ecl, educational community | educational community licen[sc]e | ecl-[12]\.0 | opensource\.org/licenses/ecl
lppl-1.3 | lppl, latex project | latex project public licen[sc]e | lppl-1\.3[ac]? | latex-project\.org/lppl
vim | vim | vim licen[sc]e | vim | vimhelp\.org/uganda
blueoak-1 | blue oak, blueoak | blue oak model licen[sc]e | blueoak-1\.0\.0 | blueoakcouncil\.org/license
mulan-2 | mulan | mulan (?:permissive software|psl) ?(?:licen[sc]e)? | mulanpsl-[12]\.0 | license\.coscl\.org\.cn/mulanpsl
sspl-1 | sspl, server side public, server-side-public | server side public licen[sc]e | sspl-1\.0 | mongodb\.com/licensing/server-side-public-license
busl-1.1 | busl, business source, mariadb.com/bsl11 | business source licen[sc]e | busl-1\.1 | mariadb\.com/bsl11
elastic-2 | elastic | elastic licen[sc]e(?: 2\.0)? | elastic-2\.0 | elastic\.co/licensing/elastic-license
openrail | rail, responsible ai, huggingface | (?:creativeml |bigscience )?(?:open )?rail(?:\+\+)?[- ]m licen[sc]e; open responsible ai licen[sc]e | (?:creativeml-)?openrail(?:\+\+)?(?:-m)? | huggingface\.co/spaces/\S*license
proprietary | all rights reserved, proprietary, confidential | all rights reserved; proprietary and confidential | proprietary | licenses/proprietary
"""

# Label | keyword, which is in every match | sentences of the licence's own text or of its notice; ... is up to 160 characters.
SENTENCES = r"""
mit | any person obtaining a copy | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | substantial portions of the software | (?:the )?above copyright notice and this permission notice(?: \(including the next paragraph\))? shall be included in all copies or substantial portions of the software
mit-0 | to deal in the software without restriction | to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the software, and to permit persons to whom the software is furnished to do so\. the software is provided
bsd | redistribution and use in source | redistribution and use in source and binary forms,? with or without modification
bsd-3 | nor the names of | neither the name of ... nor the names of (?:its|the|their) contributors may be used to endorse or promote products
bsd-4 | all advertising materials | all advertising materials mentioning features or use of this software must display
0bsd | with or without fee is hereby granted | permission to use, copy, modify,? and/or distribute this software for any purpose with or without fee is hereby granted\. the software is provided
isc | with or without fee is hereby granted | permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted,? provided that the above
postgresql | without a written agreement | permission to use, copy, modify,? and distribute this software and its documentation for any purpose, without fee, and without a written agreement
ncsa | illinois | neither the names of ... university of illinois ... may be used to endorse
x11 | x consortium | except as contained in this notice, the name of the x consortium shall not be used in advertising
apache-2 | apache license | licensed under the apache license, version 2\.0 \(the ["'“]?license["'”]?\)
apache-2 | apache license | you may not use this file except in compliance with the license\. you may obtain a copy of the license at ... apache license
apache-2 | terms and conditions for use, reproduction | apache license version 2\.0, january 2004 ... terms and conditions for use, reproduction
apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
gpl | gnu general public license | this (?:program|software|library|file) is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public license
gpl-2 | gnu general public license | gnu general public license as published by the free software foundation[;,] (?:either )?version 2
gpl-3 | gnu general public license | gnu general public license as published by the free software foundation[;,:] (?:either )?version 3
gpl-2 | gnu general public license | gnu general public license ... either version 2(?:\.0)? of the license
gpl-3 | gnu general public license | gnu general public license ... either version 3(?:\.0)? of the license
gpl-2 | version 2, june 1991 | gnu general public license version 2, june 1991
gpl-3 | version 3, 29 june 2007 | gnu general public license version 3, 29 june 2007
lgpl-2.1 | gnu lesser general public license | gnu lesser general public license ... version 2\.1 of the license
lgpl-3 | gnu lesser general public license | gnu lesser general public license ... version 3 of the license
lgpl-2 | gnu library general public license | gnu library general public license ... version 2 of the license
lgpl-2.1 | version 2.1, february 1999 | gnu lesser general public license version 2\.1, february 1999
agpl-3 | gnu affero general public license | gnu affero general public license ... version 3 of the license
agpl-3 | version 3, 19 november 2007 | gnu affero general public license version 3, 19 november 2007
gfdl-1.3 | free documentation license | permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license
mpl-2 | mozilla public license | this source code form is subject to the terms of the mozilla public license, v\. 2\.0
mpl-2 | mozilla.org/mpl/2.0 | if a copy of the mpl was not distributed with this file, you can obtain one at https?://mozilla\.org/mpl/2\.0
mpl-1.1 | mozilla public license version 1.1 | the contents of this file are subject to the mozilla public license version 1\.1
epl-1 | eclipse public license v1.0 | accompanying materials are made available under the terms of the eclipse public license v1\.0
epl-2 | eclipse public license | accompanying materials are made available under the terms of the eclipse public license 2\.0
cddl-1 | common development and distribution license | the contents of this file are subject to the terms of the common development and distribution license
artistic-2 | artistic license | this is free software; you can redistribute it and/or modify it under the terms of the artistic license 2\.0
perl | same terms as | you (?:may|can) (?:redistribute|modify) it (?:and/or modify it )?under the same terms as perl itself
zlib | in no event will the authors be held liable | this software is provided ['‘]as-is['’], without any express or implied warranty\. in no event will the authors be held liable
zlib | must not be misrepresented | the origin of this software must not be misrepresented; you must not claim that you wrote the original software
bsl-1 | person or organization obtaining a copy | permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy | anyone is free to copy, modify, publish, use, compile, sell,? or distribute this software
wtfpl | you just do what the | you just do what the f\S* you want to
cc0 | waived all copyright | to the extent possible under law, ... waived all copyright and related or neighboring rights
cc-by | creative commons attribution | this work is licensed under (?:a|the) creative commons attribution [1-4]\.0(?: international| unported| generic)? licen[sc]e
cc-by-sa | sharealike | this work is licensed under (?:a|the) creative commons attribution-sharealike [1-4]\.0(?: international| unported| generic)? licen[sc]e
cc-by-nc | noncommercial | this work is licensed under (?:a|the) creative commons attribution-noncommercial [1-4]\.0(?: international| unported| generic)? licen[sc]e
ofl-1.1 | open font license | this font software is licensed under the sil open font license
eupl-1.2 | eupl | licensed under the eupl,? version 1\.2
openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
public-domain | public domain | the authors? (?:of this (?:file|software|work) )?disclaims? copyright ... public domain
proprietary | strictly prohibited | unauthorized (?:copying|use|distribution) of this (?:file|software|material),? via any medium is strictly prohibited
"""

#: What turns the grant that follows it into none.
DENIAL = re.compile(r"\b(?:not|never|no longer|neither|isn't|aren't|wasn't|cannot be|can't be)\s+(?:\w+\s+){0,2}\Z")
GRANT = r"(?:licensed|released|distributed|available|published|provided|covered)(?: \w+){0,2}? (?:under|by|with)(?: the)?(?: terms of)?(?: the)? "


#: Identifiers with a number, as in ``apache-2.0``.
VERSIONED = re.compile(r"-(?:\(\?:)?(?:\[?\d)")


@dataclass(frozen=True)
class Signature:
    """A pattern of a label. Of overlapping detections that of higher priority stays."""

    label: str
    kind: str
    priority: int
    confidence: float
    pattern: re.Pattern


def _spaced(pattern: str) -> str:
    """White space of any kind where the pattern has a blank; none is needed where the blank is optional."""
    return pattern.replace("[- ]?", r"(?:-|\s+)?").replace("[- ]", r"(?:-|\s+)").replace(" ?", r"\s*").replace(" ", r"\s+")


def _families() -> list[tuple[tuple[str, ...], tuple[Signature, ...]]]:
    found = []
    for line in FAMILIES.strip().splitlines():
        label, keywords, names, identifier, address = (part.strip() for part in line.split(" | "))
        patterns = [
            ("tag", 4, 0.99, rf"spdx-license-identifier:\s*{identifier}(?![\w.+-]*\w)"),
            ("classifier", 3, 0.95, rf"licen[sc]e\s*[:=]\s*[\"']?{identifier}(?![\w.+-]*\w)"),
            ("address", 3, 0.95, rf"https?://(?:www\.)?{address}"),
        ]
        every = [name.strip() for name in names.split(";")]
        if VERSIONED.search(identifier):
            # Unlike ``mit`` or ``ruby`` an identifier with a version is no word of a text.
            patterns.append(("identifier", 1, 0.7, rf"(?<![\w.+-]){identifier}(?![\w.+-]*\w)"))
        patterns.append(("grant", 2, 0.9, rf"\b{GRANT}{identifier}(?![\w.+-]*\w)"))
        for name in every:
            patterns.append(("grant", 2, 0.9, rf"\b{GRANT}{name}\b"))
            patterns.append(("name", 1, 0.6, rf"\b{name}\b"))
        own = tuple(Signature(label, kind, priority, sure, re.compile(_spaced(text))) for kind, priority, sure, text in patterns)
        found.append((tuple(word.strip() for word in keywords.split(",")), own))
    return found


def _sentences() -> list[tuple[tuple[str, ...], tuple[Signature, ...]]]:
    found = []
    for line in SENTENCES.strip().splitlines():
        label, keyword, text = (part.strip() for part in line.split(" | "))
        pattern = re.compile(_spaced(text).replace(r"\s+...\s+", r"[\s\S]{1,160}?"))
        found.append(((keyword,), (Signature(label, "text", 4, 0.97, pattern),)))
    return found


#: (keywords, signatures) of every licence, in order.
RULES = _families() + _sentences()
