"""Signature rules for license statements, written over normalised words.

A text is a row of words (digits, a to z, anything beyond ASCII) joined by single
spaces, so "CC BY-NC 4.0" reads "cc by nc 4 0". Each line of a table is

    label | gate | pattern

where the pattern matches whole words and every match holds one of the gate's words
or word runs (alternatives are separated by a slash). NAMES also give a notice rule
each ("licensed under ..."), and IDS give a tag rule each ("spdx license identifier ...").
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: kind: (priority, weight of a finding).
KINDS = {
    "tag": (6, 0.98), "text": (5, 0.95), "notice": (4, 0.95), "url": (3, 0.9),
    "name": (2, 0.7), "hint": (1, 0.3), "base": (0, 0.5),
}

#: Phrases whose every place counts, and their labels.
BASE = """
cc-by | cc by | cc by
gpl | general public license | general public license
reserved | all rights reserved | all rights reserved
"""

INTRO = (
    r"(?:(?:this|the|these|all) (?:\w+ ){1,3}(?:is|are) )?"
    r"(?:dual )?(?:licen[cs]ed|released|distributed|published|available|offered|provided|covered|shared|redistributed|governed|made available)"
    r"(?: to you)?(?: (?:and|or) \w+)? (?:under|by|subject to|with|on|in accordance with)"
    r"(?: (?:either )?(?:the )?(?:terms|conditions|provisions|restrictions)(?: and (?:conditions|limitations))? (?:of|in))?(?: (?:the|an|a))? "
)

NAMES = r"""
apache-1.0 | apache | apache (?:software )?license (?:version |v )?1 0
apache-1.1 | apache | apache (?:software )?license (?:version |v )?1 1
apache-2.0 | apache | apache (?:software )?license (?:version |v )?v?2(?: 0)?
apache-2.0 | asl | asl 2 0
apache | apache | apache (?:software )?license
mit | mit | mit(?: x11)? licen[cs]e
mit-0 | mit | mit no attribution(?: licen[cs]e)?
x11 | x11 | x11 licen[cs]e
expat | expat | expat licen[cs]e
isc | isc | isc licen[cs]e
bsd-0-clause | bsd | (?:zero|0) clause bsd(?: licen[cs]e)?
bsd-2-clause | bsd | (?:(?:simplified|freebsd|two clause|2 clause) bsd|bsd (?:2|two) clause)(?: licen[cs]e)?
bsd-3-clause | bsd | (?:(?:new|modified|revised|three clause|3 clause) bsd|bsd (?:3|three) clause)(?: licen[cs]e)?
bsd-4-clause | bsd | (?:(?:original|old|four clause|4 clause) bsd|bsd (?:4|four) clause)(?: licen[cs]e)?
bsd-3-clause-clear | bsd | (?:bsd 3 clause clear|clear bsd)(?: licen[cs]e)?
bsd | bsd | bsd(?: style)? licen[cs]e
gpl-1.0 | general public licen | gnu general public licen[cs]e (?:version |v )?v?1(?: 0)?
gpl-2.0 | general public licen | gnu general public licen[cs]e (?:version |v )?v?2(?: 0)?
gpl-3.0 | general public licen | gnu general public licen[cs]e (?:version |v )?v?3(?: 0)?
gpl-2.0 | gpl/gplv2 | (?:gnu )?gpl ?(?:version |v )?v?2(?: 0)?
gpl-3.0 | gpl/gplv3 | (?:gnu )?gpl ?(?:version |v )?v?3(?: 0)?
gpl-any | general public licen | gnu general public licen[cs]e
gpl-any | gpl | gnu gpl
gpl-classpath | classpath exception | (?:gpl with )?(?:the )?classpath exception
lgpl-2.0 | library general public licen | gnu library general public licen[cs]e (?:version |v )?v?2(?: 0)?
lgpl-2.1 | lesser general public licen | gnu lesser general public licen[cs]e (?:version |v )?v?2 1
lgpl-3.0 | lesser general public licen | gnu lesser general public licen[cs]e (?:version |v )?v?3(?: 0)?
lgpl-2.1 | lgpl/lgplv2 | (?:gnu )?lgpl ?(?:version |v )?v?2 1
lgpl-3.0 | lgpl/lgplv3 | (?:gnu )?lgpl ?(?:version |v )?v?3(?: 0)?
lgpl-any | lesser general public licen/library general public licen | (?:gnu )?(?:lesser|library) general public licen[cs]e
lgpl-any | lgpl | gnu lgpl
agpl-1.0 | affero general public licen | affero general public licen[cs]e (?:version |v )?v?1(?: 0)?
agpl-3.0 | affero general public licen | (?:gnu )?affero general public licen[cs]e (?:version |v )?v?3(?: 0)?
agpl-3.0 | agpl/agplv3 | (?:gnu )?agpl ?(?:version |v )?v?3(?: 0)?
agpl-any | affero general public licen | (?:gnu )?affero general public licen[cs]e
gfdl-1.1 | free documentation licen | gnu free documentation licen[cs]e (?:version |v )?1 1
gfdl-1.2 | free documentation licen | gnu free documentation licen[cs]e (?:version |v )?1 2
gfdl-1.3 | free documentation licen | gnu free documentation licen[cs]e (?:version |v )?1 3
gfdl | free documentation licen | gnu free documentation licen[cs]e
mpl-1.0 | mozilla public | mozilla public licen[cs]e (?:version |v )?1 0
mpl-1.1 | mozilla public | mozilla public licen[cs]e (?:version |v )?1 1
mpl-2.0 | mozilla public | mozilla public licen[cs]e (?:version |v )?2 0
mpl-2.0 | mpl | mpl (?:version |v )?2 0
mpl | mozilla public | mozilla public licen[cs]e
epl-1.0 | eclipse public | eclipse public licen[cs]e (?:version |v )?v?1(?: 0)?
epl-2.0 | eclipse public | eclipse public licen[cs]e (?:version |v )?v?2(?: 0)?
epl | eclipse public | eclipse public licen[cs]e
edl-1.0 | eclipse distribution | eclipse distribution licen[cs]e(?: (?:version |v )?v?1(?: 0)?)?
cpl-1.0 | common public licen | common public licen[cs]e(?: (?:version |v )?1 0)?
ipl-1.0 | ibm public | ibm public licen[cs]e(?: (?:version |v )?1 0)?
cddl-1.0 | common development and distribution | common development and distribution licen[cs]e(?: (?:version |v )?1 0)?
cddl-1.1 | common development and distribution | common development and distribution licen[cs]e (?:version |v )?1 1
eupl-1.1 | european union public | european union public licen[cs]e (?:version |v )?1 1
eupl-1.2 | european union public | european union public licen[cs]e (?:version |v )?1 2
eupl | european union public | european union public licen[cs]e
cecill-2.1 | cecill | cecill(?: (?:free software )?licen[cs]e)?(?: agreement)? (?:version |v )?2 1
cecill-b | cecill | cecill b(?: licen[cs]e)?
cecill-c | cecill | cecill c(?: licen[cs]e)?
cecill | cecill | cecill(?: licen[cs]e)?
artistic-1.0 | artistic | (?:perl )?artistic licen[cs]e (?:version |v )?1 0
artistic-2.0 | artistic | artistic licen[cs]e (?:version |v )?2 0
artistic | artistic | (?:perl )?artistic licen[cs]e
perl | terms as perl | same terms as perl(?: itself)?
python-2.0 | python software foundation/psf | (?:python software foundation|psf) licen[cs]e(?: (?:version |v )?2)?
php-3.01 | php | php licen[cs]e(?: (?:version |v )?3 0?1)?
ruby | ruby | ruby licen[cs]e
zlib | zlib | zlib(?: libpng)? licen[cs]e
libpng | libpng | libpng licen[cs]e(?: (?:version |v )?2)?
boost-1.0 | boost | boost software licen[cs]e(?: (?:version |v )?1 0)?
bsl-1.1 | business source | business source licen[cs]e(?: (?:version |v )?1 1)?
sspl-1.0 | server side public | server side public licen[cs]e(?: (?:version |v )?1)?
elastic-2.0 | elastic licen | elastic licen[cs]e(?: (?:version |v )?2(?: 0)?)?
commons-clause | commons clause | commons clause(?: licen[cs]e)?(?: condition)?(?: (?:version |v )?1 0)?
unlicense | unlicense | (?:the )?unlicense
wtfpl | do what the fuck/wtfpl | (?:wtfpl|do what the fuck you want to public licen[cs]e)(?: (?:version |v )?2)?
beerware | beerware/beer ware | beer ?ware licen[cs]e
json | json | json licen[cs]e
ncsa | ncsa | (?:university of illinois )?ncsa(?: open source)? licen[cs]e
w3c | w3c | w3c(?: software)?(?: notice and)? licen[cs]e
unicode-3.0 | unicode | unicode licen[cs]e(?: v3)?
icu | icu | icu licen[cs]e
ofl-1.0 | open font | (?:sil )?open font licen[cs]e (?:version |v )?1 0
ofl-1.1 | open font | (?:sil )?open font licen[cs]e(?: (?:version |v )?1 1)?
ubuntu-font-1.0 | ubuntu font | ubuntu font licen[cs]e(?: (?:version |v )?1 0)?
afl-3.0 | academic free | academic free licen[cs]e(?: (?:version |v )?[123] \d)?
osl-3.0 | open software licen | open software licen[cs]e(?: (?:version |v )?3 0)?
ecl-2.0 | educational community | educational community licen[cs]e(?: (?:version |v )?2 0)?
ms-pl | microsoft public | microsoft public licen[cs]e
ms-rl | microsoft reciprocal | microsoft reciprocal licen[cs]e
mulan-2.0 | mulan | mulan (?:psl|permissive software licen[cs]e)(?: (?:version |v )?v?2)?
upl-1.0 | universal permissive | universal permissive licen[cs]e(?: (?:version |v )?v?1 0)?
blueoak-1.0 | blue oak | blue oak model licen[cs]e(?: (?:version |v )?1 0 0)?
qpl-1.0 | q public/qt public/qpl | (?:qpl|qt? public licen[cs]e)(?: (?:version |v )?1 0)?
sleepycat | sleepycat | sleepycat licen[cs]e
openssl | openssl | openssl licen[cs]e
vim | vim | vim licen[cs]e
postgresql | postgresql | postgresql licen[cs]e
curl | curl | curl licen[cs]e
cc0-1.0 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: licen[cs]e| public domain dedication)?
cc0-1.0 | commons zero | creative commons zero(?: (?:version |v )?1 0)?(?: licen[cs]e)?
cc-by-1.0 | cc by | cc by 1 0
cc-by-2.0 | cc by | cc by 2 0
cc-by-2.5 | cc by | cc by 2 5
cc-by-3.0 | cc by | cc by 3 0
cc-by-4.0 | cc by | cc by 4 0
cc-by-sa-3.0 | cc by sa | cc by sa 3 0
cc-by-sa-4.0 | cc by sa | cc by sa 4 0
cc-by-sa | cc by sa | cc by sa(?: [12] \d)?
cc-by-nd-4.0 | cc by nd | cc by nd 4 0
cc-by-nd | cc by nd | cc by nd(?: [123] \d)?
cc-by-nc-3.0 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | cc by nc | cc by nc 4 0
cc-by-nc | cc by nc | cc by nc(?: [12] \d)?
cc-by-nc-sa-3.0 | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-sa | cc by nc sa | cc by nc sa(?: [12] \d)?
cc-by-nc-nd-3.0 | cc by nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc by nc nd | cc by nc nd 4 0
cc-by-nc-nd | cc by nc nd | cc by nc nd(?: [12] \d)?
cc-by-4.0 | commons attribution | creative commons attribution 4 0(?: international)?(?: licen[cs]e)?
cc-by-3.0 | commons attribution | creative commons attribution 3 0(?: unported)?(?: licen[cs]e)?
cc-by-sa-4.0 | commons attribution | creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa-3.0 | commons attribution | creative commons attribution share ?alike 3 0(?: unported)?(?: licen[cs]e)?
cc-by-nd-4.0 | commons attribution | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-4.0 | commons attribution | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-sa-4.0 | commons attribution | creative commons attribution non ?commercial share ?alike 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-nd-4.0 | commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-sa | commons attribution | creative commons attribution non ?commercial share ?alike(?: licen[cs]e)?
cc-by-nc-nd | commons attribution | creative commons attribution non ?commercial no ?deriv(?:ative)?s(?: licen[cs]e)?
cc-by-nc | commons attribution | creative commons attribution non ?commercial(?: licen[cs]e)?
cc-by-sa | commons attribution | creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-nd | commons attribution | creative commons attribution no ?deriv(?:ative)?s(?: licen[cs]e)?
cc-by-any | commons attribution | creative commons attribution(?: licen[cs]e)?
cc | creative commons | creative commons licen[cs]e
pddl-1.0 | public domain dedication | (?:open data commons )?public domain dedication and licen[cs]e
odbl-1.0 | open database/odbl | (?:odbl|(?:open data commons )?open database licen[cs]e)(?: (?:version |v )?1 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution licen[cs]e(?: (?:version |v )?v?1 0)?
ogl-uk-3.0 | open government | open government licen[cs]e(?: (?:version |v )?v?3 0)?
etalab-2.0 | etalab/licence ouverte | (?:etalab open licen[cs]e|open licen[cs]e etalab|licence ouverte(?: etalab)?)(?: (?:version |v )?2 0)?
cdla-permissive | community data licen | community data licen[cs]e agreement permissive(?: (?:version |v )?[12] 0)?
cdla-sharing | community data licen | community data licen[cs]e agreement sharing(?: (?:version |v )?1 0)?
openrail-m | openrail/open rail | (?:bigscience |creativeml )?open ?rail(?: ?m)?(?: licen[cs]e)?
lppl-1.3 | latex project public | latex project public licen[cs]e(?: (?:version |v )?1 3(?:c| c)?)?
opl-1.0 | open publication | open publication licen[cs]e(?: (?:version |v )?v?1 0)?
free-art-1.3 | free art/licence art libre | (?:free art licen[cs]e|licence art libre)(?: (?:version |v )?1 3)?
against-drm | against drm | against drm licen[cs]e
apsl-2.0 | apple public source | apple public source licen[cs]e(?: (?:version |v )?2 0)?
intel | intel open source/intel simplified | intel (?:open source|simplified software) licen[cs]e
npl-1.1 | netscape public | netscape public licen[cs]e(?: (?:version |v )?1 [01])?
spl-1.0 | sun public | sun public licen[cs]e(?: (?:version |v )?1 0)?
sissl | sun industry standards | sun industry standards source licen[cs]e(?: (?:version |v )?1 [12])?
rpl-1.5 | reciprocal public | reciprocal public licen[cs]e(?: (?:version |v )?1 [15])?
polyform-nc | polyform noncommercial | polyform noncommercial licen[cs]e(?: 1 0 0)?
polyform-sb | polyform small business | polyform small business licen[cs]e(?: 1 0 0)?
prosperity | prosperity public | prosperity public licen[cs]e(?: 3 0 0)?
parity | parity public | parity public licen[cs]e(?: 7 0 0)?
hippocratic | hippocratic | hippocratic licen[cs]e(?: (?:version |v )?[123] \d)?
cern-ohl | cern open hardware | cern open hardware licen[cs]e(?: (?:version |v )?\d(?: \d)?)?
solderpad | solderpad | solderpad hardware licen[cs]e(?: (?:version |v )?\d(?: \d+)?)?
"""

TEXTS = r"""
mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | shall be included in all copies | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | provided as is without warranty | the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted(?: provided that the above copyright notice)?
bsd-2-clause | redistributions of source code | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd-2-clause | redistributions in binary form | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | endorse or promote | neither the name of (?:\w+ ){1,12}(?:may|nor the names of its contributors may) be used to endorse or promote products derived from
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
apache-2.0 | you may not use this file | you may not use this file except in compliance with the license
apache-2.0 | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | each contributor hereby grants | subject to the terms and conditions of this license each contributor hereby grants to you
apache-1.1 | end user documentation | the end user documentation included with the redistribution if any must include the following acknowledge?ment
gpl-any | free software foundation | you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
gpl-2.0-or-later | version 2 of the license | either version 2 of the license or at your option any later version
gpl-3.0-or-later | version 3 of the license | either version 3 of the license or at your option any later version
lgpl-2.1-or-later | version 2 1 of the license | either version 2 1 of the license or at your option any later version
gpl-any | hope that it will be useful | (?:this program|it) is distributed in the hope that it will be useful but without any warranty
gpl-any | received a copy of the gnu general | you should have received a copy of the gnu general public licen[cs]e along with this
lgpl-any | received a copy of the gnu lesser | you should have received a copy of the gnu lesser general public licen[cs]e along with this
agpl-any | received a copy of the gnu affero | you should have received a copy of the gnu affero general public licen[cs]e along with this
gpl-2.0 | gnu general public license version 2 june 1991 | gnu general public license version 2 june 1991
gpl-3.0 | gnu general public license version 3 29 june 2007 | gnu general public license version 3 29 june 2007
agpl-3.0 | remote network interaction | remote network interaction use with the gnu general public licen[cs]e
lgpl-any | linking exception/executable that is not covered | as a special exception (?:\w+ ){0,12}link(?:ing)? (?:\w+ ){0,8}executable that is not covered
gpl-classpath | independent modules | permission to link this library with independent modules to produce an executable
gfdl | invariant sections | with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
mpl-2.0 | this source code form is subject | this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0
mpl-2.0 | if a copy of the mpl | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 | contents of this file are subject to the mozilla | the contents of this file are subject to the mozilla public licen[cs]e version 1 1
epl-2.0 | accompanying materials are made available | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2 0
epl-1.0 | accompanying materials are made available | this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1 0
cddl-1.0 | contents of this file are subject to the terms of the common development | the contents of this file are subject to the terms of the common development and distribution licen[cs]e
zlib | provided as is without any express | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | origin of this software must not | the origin of this software must not be misrepresented
boost-1.0 | machine executable object code | solely in the form of machine executable object code generated by a source language processor
unlicense | released into the public domain | this is free and unencumbered software released into the public domain
unlicense | anyone is free to copy modify | anyone is free to copy modify publish use compile sell or distribute this software
wtfpl | you just do what the fuck | you just do what the fuck you want to
beerware | buy me a beer | you can buy me a beer in return
json | shall be used for good | the software shall be used for good not evil
artistic-2.0 | copyright holder may make | each contributor irrevocably grants (?:\w+ ){0,6}copyright holder may make
python-2.0 | psf hereby grants | psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e
cc0-1.0 | waived all copyright | (?:has|have) waived all copyright and related or neighbou?ring rights
cc-by-any | attribute the work in the manner | you must attribute the work in the manner specified by the author or licensor
cc-by-any | free to share copy | you are free to share copy and redistribute the material in any medium or format
cc-by-sa | distribute your contributions under the same | you must distribute your contributions under the same licen[cs]e as the original
cc-by-nc | material for commercial purposes | you may not use the material for commercial purposes
cc-by-nd | distribute the modified material | you may not distribute the modified material
odbl-1.0 | database is made available under | this (?:\w+ ){0,4}database is made available under the open database licen[cs]e
ofl-1.1 | font software is licensed under | this font software is licensed under the sil open font licen[cs]e
ms-pl | if you use the software you accept | if you use the software you accept this licen[cs]e
sspl-1.0 | functionality of the program available | making the functionality of the program available to third parties as a service
bsl-1.1 | additional use grant | additional use grant
elastic-2.0 | hosted or managed service | provide the software to third parties as a hosted or managed service
openssl | developed by the openssl project | this product includes software developed by the openssl project
json | json org | copyright (?:c )?\d{4} json org
x11 | x consortium shall not | except as contained in this notice the name of the x consortium shall not be used
ncsa | deal with the software without restriction | to deal with the software without restriction including
curl | daniel stenberg | copyright (?:c )?\d{4}(?: \d{4})? daniel stenberg
proprietary | confidential and proprietary/proprietary and confidential | (?:confidential and proprietary|proprietary and confidential)
proprietary | unauthorized copying | unauthorized copying of this file via any medium is strictly prohibited
proprietary | prior written | (?:may|must) not be (?:\w+ ){1,8}without (?:the )?prior written (?:permission|consent)
proprietary | no part of this | no part of this (?:\w+ ){1,3}may be reproduced
proprietary | trade secret | (?:constitutes|contains) (?:\w+ ){0,4}trade secrets?
proprietary | end user license agreement/end user licence agreement/eula | (?:end user licen[cs]e agreement|eula)
public-domain | public domain | (?:is|are|been|placed|released|dedicated|put) (?:\w+ ){0,3}(?:in|into|to) the public domain
public-domain | work of the united states government/work of the u s government | (?:is a|a) work of the (?:united states|u s) government
public-domain | no known copyright | no known copyright restrictions
non-commercial | non commercial use/noncommercial use | for (?:personal |private )?(?:and )?non ?commercial use(?: only)?
research-only | research purposes only/research use only | (?:for|to) (?:academic |scientific )?(?:and )?research (?:purposes|use) only
no-ai | machine learning/text and data mining | (?:may|must) not be used (?:\w+ ){0,6}(?:to train|for) (?:\w+ ){0,6}(?:machine learning|text and data mining)
press | reprinted with permission | reprinted with permission
permission | used with permission/used by permission | used (?:with|by) permission
"""

URLS = r"""
apache-2.0 | apache org | (?:www )?apache org licenses license 2 0(?: (?:txt|html))?
apache | apache org | (?:www )?apache org licenses
mit | opensource org | opensource org licen[cs]es? mit(?: license)?(?: php)?
bsd-2-clause | opensource org | opensource org licen[cs]es? bsd 2 clause
bsd-3-clause | opensource org | opensource org licen[cs]es? bsd 3 clause
gpl-2.0 | gnu org | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: (?:txt|html|en html))?
gpl-3.0 | gnu org | (?:www )?gnu org licenses gpl 3 0(?: (?:txt|html|en html))?
gpl-any | gnu org | (?:www )?gnu org licenses gpl(?: (?:txt|html))?
lgpl-2.1 | gnu org | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: (?:txt|html))?
lgpl-any | gnu org | (?:www )?gnu org licenses lgpl(?: (?:txt|html))?
agpl-3.0 | gnu org | (?:www )?gnu org licenses agpl(?: 3 0)?(?: (?:txt|html))?
gfdl | gnu org | (?:www )?gnu org licenses fdl(?: 1 [123])?(?: (?:txt|html))?
gnu | gnu org | (?:www )?gnu org licenses
mpl-2.0 | mozilla org | (?:www )?mozilla org (?:en us )?mpl 2 0
mpl | mozilla org | (?:www )?mozilla org mpl
epl-1.0 | eclipse org | (?:www )?eclipse org legal epl v10(?: html)?
epl-2.0 | eclipse org | (?:www )?eclipse org legal epl (?:v20|2 0)(?: html)?
cc-by-4.0 | creativecommons org | creativecommons org licenses by 4 0
cc-by-3.0 | creativecommons org | creativecommons org licenses by 3 0
cc-by-sa-4.0 | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-nd-4.0 | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nc-4.0 | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc-sa-4.0 | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | creativecommons org | creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nc-sa | creativecommons org | creativecommons org licenses by nc sa
cc-by-nc-nd | creativecommons org | creativecommons org licenses by nc nd
cc-by-nc | creativecommons org | creativecommons org licenses by nc
cc-by-sa | creativecommons org | creativecommons org licenses by sa
cc-by-any | creativecommons org | creativecommons org licenses by
cc0-1.0 | creativecommons org | creativecommons org publicdomain zero(?: 1 0)?
public-domain | creativecommons org | creativecommons org publicdomain mark(?: 1 0)?
odbl-1.0 | opendatacommons org | opendatacommons org licenses odbl(?: 1 0)?
pddl-1.0 | opendatacommons org | opendatacommons org licenses pddl(?: 1 0)?
odc-by-1.0 | opendatacommons org | opendatacommons org licenses by(?: 1 0)?
ofl-1.1 | scripts sil org | scripts sil org ofl
ogl-uk-3.0 | nationalarchives gov uk | nationalarchives gov uk doc open government licen[cs]e(?: version 3)?
unlicense | unlicense org | unlicense org
wtfpl | wtfpl net | (?:www )?wtfpl net
boost-1.0 | boost org | (?:www )?boost org license 1 0 txt
cddl-1.0 | opensource org | opensource org licen[cs]es? cddl(?: 1 0)?
isc | opensource org | opensource org licen[cs]es? isc
zlib | opensource org | opensource org licen[cs]es? zlib
eupl | joinup ec europa eu | joinup ec europa eu (?:\w+ ){0,4}eupl
cecill | cecill info | (?:www )?cecill info(?: licences)?
elastic-2.0 | elastic co | (?:www )?elastic co licensing elastic license
mulan-2.0 | license coscl org | license coscl org cn mulanpsl2
"""

HINTS = r"""
copyright | copyright | copyright (?:c )?(?:by )?(?:19|20)\d\d
copyright | © | © (?:19|20)\d\d
license-file | license/licence | see (?:the )?(?:accompanying )?licen[cs]e(?: (?:file|txt|md))?(?: for)? (?:details|more|information)
license-file | license/licence/copying | (?:license|licence|copying) (?:txt|md|file)
open-source | open source | open source licen[cs]e
free-software | free software | (?:this|it) is free software
copyleft | copyleft | copyleft
no-warranty | warranty/warranties | (?:without warranty|no warranty|without warranties)(?: of any kind)?
royalty-free | royalty free | royalty free(?: licen[cs]e)?
trademark | trademark/trademarks | (?:is a |are )?(?:registered )?trademarks? of
patent | patent/patents | patent (?:licen[cs]e|grant)
rights | rights | (?:some|certain) rights reserved
rights | rights | no rights reserved
rights | rechte | alle rechte vorbehalten
rights | derechos | todos los derechos reservados
rights | droits | tous droits réservés
rights | rechte | rechte vorbehalten
"""

IDS = """
afl-3.0 agpl-1.0 agpl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-2.0 blueoak-1.0 bsd-2-clause
bsd-3-clause bsd-4-clause cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nc-nd-3.0
cc-by-nc-nd-4.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nd-4.0 cc-by-sa-3.0 cc-by-sa-4.0 cc0-1.0 cddl-1.0 cddl-1.1
cecill-2.1 cecill-b cecill-c cpl-1.0 curl ecl-2.0 elastic-2.0 epl-1.0 epl-2.0 etalab-2.0 eupl-1.1 eupl-1.2 gfdl-1.1
gfdl-1.2 gfdl-1.3 gpl-1.0 gpl-2.0 gpl-2.0-or-later gpl-3.0 gpl-3.0-or-later icu intel ipl-1.0 isc json lgpl-2.0 lgpl-2.1
lgpl-2.1-or-later lgpl-3.0 libpng lppl-1.3 mit mit-0 mpl-1.0 mpl-1.1 mpl-2.0 ms-pl ms-rl ncsa npl-1.1 odbl-1.0 odc-by-1.0
ofl-1.0 ofl-1.1 ogl-uk-3.0 openssl osl-3.0 pddl-1.0 php-3.01 postgresql python-2.0 qpl-1.0 rpl-1.5 ruby sissl sleepycat
spl-1.0 sspl-1.0 unlicense upl-1.0 vim w3c wtfpl x11 zlib
"""


@dataclass(frozen=True)
class Rule:
    number: int
    label: str
    kind: str
    gates: tuple[str, ...]
    pattern: re.Pattern

    @property
    def priority(self) -> int:
        return KINDS[self.kind][0]


def seen(text: str) -> str:
    """How a table's text reads once its UTF-8 bytes are taken as characters."""
    return text.encode().decode("latin-1")


def _made(number: int, label: str, kind: str, gate: str, pattern: str) -> Rule:
    # \w stands for any character of a word; words end at a space or at the text's ends
    inner = seen(pattern).replace(r"\w", "[^ ]")
    gates = tuple(seen(g.strip()) for g in gate.split("/"))
    return Rule(number, label, kind, gates, re.compile(rf"(?<![^ ])(?:{inner})(?![^ ])"))


def _lines(table: str):
    for line in table.strip().splitlines():
        label, gate, pattern = (x.strip() for x in line.split(" | "))
        yield label, gate, pattern


def rules() -> list[Rule]:
    """All rules, in the order that decides between equal findings."""
    out: list[tuple[str, str, str, str]] = []
    for label in IDS.split():
        words = re.sub(r"[^0-9a-z]+", " ", label)
        out.append((label, "tag", "spdx", rf"spdx licen[cs]e identifier {words}(?: (?:only|or later))?"))
    out += [(label, "text", gate, pattern) for label, gate, pattern in _lines(TEXTS)]
    out += [(label, "notice", gate, f"{INTRO}(?:{pattern})") for label, gate, pattern in _lines(NAMES)]
    out += [(label, "url", gate, pattern) for label, gate, pattern in _lines(URLS)]
    out += [(label, "name", gate, pattern) for label, gate, pattern in _lines(NAMES)]
    out += [(label, "hint", gate, pattern) for label, gate, pattern in _lines(HINTS)]
    out += [(label, "base", gate, pattern) for label, gate, pattern in _lines(BASE)]
    return [_made(i, *row) for i, row in enumerate(out)]
