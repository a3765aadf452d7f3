"""License signatures in the order in which they are asked: label | priority | first words | how it goes on.

Texts are looked at as lower-case words with a single space between them: "GPL-3.0-or-later" is gpl 3 0 or later. A signature
begins with one of its first words, the keywords that it is gated by; the rest is a regular expression
over the words that follow. Priorities: 5 a grant or a notice in the license's own words, 4 a name with its version or an identifier,
3 a name without version, or an address, 2 a statement that leaves the license open, 1 a lone hint.
"""

#: Written by hand.
TEXT = r"""
gpl-1.0 | 5 | gnu | general public license (?:as published by the free software foundation )?(?:either )?version 1
gpl-2.0 | 5 | gnu | general public license as published by the free software foundation (?:either )?version 2
gpl-2.0-only | 5 | gnu | general public license version 2 only
gpl-2.0-or-later | 5 | gnu | general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3.0 | 5 | gnu | general public license as published by the free software foundation (?:either )?version 3
gpl-3.0-or-later | 5 | gnu | general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2.0 | 4 | gnu | (?:general public license|gpl) (?:version |v )?v?2(?: 0)?
gpl-3.0 | 4 | gnu | (?:general public license|gpl) (?:version |v )?v?3(?: 0)?
gpl-2.0 | 4 | gpl | (?:version )?v?2(?: 0)?
gpl-3.0 | 4 | gpl | (?:version )?v?3(?: 0)?
gpl-2.0 | 4 | gplv2,gpl2 |
gpl-3.0 | 4 | gplv3,gpl3 |
gpl-1.0-or-later | 4 | gpl | 1 0 or later
gpl-2.0-only | 4 | gpl | 2 0 only
gpl-2.0-or-later | 4 | gpl | 2 0 or later
gpl-3.0-only | 4 | gpl | 3 0 only
gpl-3.0-or-later | 4 | gpl | 3 0 or later
gpl-2.0-or-later | 4 | gplv2 | (?:or later|plus)
gpl-3.0-or-later | 4 | gplv3 | (?:or later|plus)
gpl-3.0-or-later | 4 | gnu | general public license (?:version |v )?v?3(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl-2.0-or-later | 4 | gnu | general public license (?:version |v )?v?2(?: 0)? or (?:at your option )?(?:any )?later(?: version)?
gpl | 3 | gnu | (?:general public license|gpl)
gpl | 3 | gpl | (?:license|licensed|licence|compatible)
gpl-2.0 | 3 | gnu | org licenses (?:old licenses )?gpl 2 0
gpl-3.0 | 3 | gnu | org licenses gpl 3 0
gpl | 3 | gnu | org (?:licenses|copyleft) gpl
gpl-2.0-with-classpath-exception | 5 | linking | this library statically or dynamically with other modules is making a combined work based on this library
gpl-2.0-with-classpath-exception | 4 | classpath | exception 2 0
gpl-2.0-with-classpath-exception | 3 | classpath | exception
gpl-3.0-with-gcc-exception | 4 | gcc | (?:runtime library )?exception 3 1
gpl-with-bison-exception | 4 | bison | exception
gpl-with-font-exception | 4 | font | exception 2 0
linux-syscall-note | 4 | linux | syscall note
lgpl-2.0 | 5 | gnu | library general public license as published by the free software foundation (?:either )?version 2
lgpl-2.1 | 5 | gnu | lesser general public license as published by the free software foundation (?:either )?version 2 1
lgpl-3.0 | 5 | gnu | lesser general public license as published by the free software foundation (?:either )?version 3
lgpl-2.0 | 4 | gnu | library general public license (?:version |v )?v?2(?: 0)?
lgpl-2.1 | 4 | gnu | lesser general public license (?:version |v )?v?2 1
lgpl-3.0 | 4 | gnu | lesser general public license (?:version |v )?v?3(?: 0)?
lgpl-2.0 | 4 | lgpl | v?2 0(?: only| or later)?
lgpl-2.1 | 4 | lgpl | (?:version )?v?2 1
lgpl-2.1-only | 4 | lgpl | 2 1 only
lgpl-2.1-or-later | 4 | lgpl | 2 1 or later
lgpl-3.0 | 4 | lgpl | (?:version )?v?3(?: 0)?
lgpl-3.0-only | 4 | lgpl | 3 0 only
lgpl-3.0-or-later | 4 | lgpl | 3 0 or later
lgpl-2.1 | 4 | lgplv2 | 1
lgpl-3.0 | 4 | lgplv3 |
lgpl | 3 | gnu | (?:lesser|library) general public license
lgpl | 3 | gnu | org (?:licenses|copyleft) (?:lgpl|lesser)
lgpl | 3 | lgpl | (?:license|licensed|licence)
lgpllr | 4 | lesser | general public license for linguistic resources
agpl-3.0 | 5 | gnu | affero general public license as published by the free software foundation (?:either )?version 3
agpl-3.0-or-later | 5 | gnu | affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
agpl-3.0 | 4 | gnu | affero general public license (?:version |v )?v?3(?: 0)?
agpl-3.0 | 4 | agpl | (?:version )?v?3(?: 0)?
agpl-3.0-only | 4 | agpl | 3 0 only
agpl-3.0-or-later | 4 | agpl | 3 0 or later
agpl-3.0 | 4 | agplv3 |
agpl-1.0 | 4 | affero | general public license version 1
agpl | 3 | gnu | affero general public license
agpl | 3 | affero | (?:gpl|general public license)
gfdl-1.1 | 4 | gnu | free documentation license version 1 1
gfdl-1.2 | 4 | gnu | free documentation license version 1 2
gfdl-1.3 | 4 | gnu | free documentation license version 1 3
gfdl | 4 | gfdl | 1 [123]
gfdl | 3 | gnu | free documentation license
apache-1.0 | 4 | apache | (?:software )?license version 1 0
apache-1.1 | 4 | apache | (?:software )?license version 1 1
apache-2.0 | 5 | licensed | (?:to the apache software foundation asf )?under (?:one or more contributor license agreements|the apache license version 2 0 the license you may not use this file except in compliance with the license)
apache-2.0 | 4 | licensed,released,distributed,available | under the (?:terms of the )?apache (?:software )?license (?:version |v )?v?2(?: 0)?
apache-2.0 | 4 | apache | (?:software )?licen[cs]e (?:version |v )?v?2(?: 0)?
apache-2.0 | 4 | apache | (?:version |v )?v?2(?: 0)?
apache-1.1 | 4 | apache | 1 1
apache-2.0 | 4 | apache2 | (?:0|license|licensed)
apache-2.0 | 4 | asl | (?:version )?v?2(?: 0)?
apache-2.0 | 3 | apache | org licenses license 2 0
apache | 3 | apache | (?:software )?licen[cs]e
apache-2.0-with-llvm-exception | 4 | apache | 2 0 with llvm exceptions?
apache-2.0-with-llvm-exception | 3 | llvm | exceptions?
mit | 5 | permission | is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 5 | software | is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit | 4 | licensed,released,distributed,available,published | under the (?:terms of the )?(?:mit|expat) licen[cs]e
mit | 4 | licence,license,licenses | mit
mit | 4 | mit | (?:expat )?licen[cs]ed?
mit-0 | 4 | mit | (?:0|no attribution)(?: license)?
mit | 3 | expat | licen[cs]e
mit | 3 | opensource | org licenses mit
mit-x11 | 4 | x11 | licen[cs]e
mit-x11 | 4 | mit | x11(?: license)?
mit-feh | 4 | mit | feh
mit-advertising | 4 | mit | advertising
bsd-0-clause | 4 | 0bsd |
bsd-0-clause | 4 | zero | clause bsd(?: license)?
bsd-1-clause | 4 | bsd | 1 clause
bsd-2-clause | 4 | bsd | 2 clause(?: license)?
bsd-2-clause | 4 | simplified | bsd licen[cs]e
bsd-2-clause-patent | 4 | bsd | 2 clause patent
bsd-2-clause-views | 4 | bsd | 2 clause views
bsd-2-clause | 5 | redistributions | of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form
bsd-3-clause | 4 | bsd | 3 clause(?: license)?
bsd-3-clause | 4 | modified,revised | (?:clause )?bsd licen[cs]e
bsd-3-clause-clear | 4 | bsd | 3 clause clear
bsd-3-clause-lbnl | 4 | bsd | 3 clause lbnl
bsd-3-clause | 5 | neither | the name of (?:the )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products
bsd-4-clause | 4 | bsd | 4 clause(?: license)?
bsd-4-clause | 4 | original | (?:clause )?bsd licen[cs]e
bsd-4-clause | 5 | advertising | materials mentioning features or use of this software must display the following acknowledgement
bsd | 5 | redistribution | and use in source and binary forms with or without modification are permitted
bsd | 4 | licensed,released,distributed,available | under (?:the|a) (?:terms of the )?bsd(?: style)? licen[cs]e
bsd | 3 | bsd | (?:style )?licen[cs]ed?
bsd | 3 | opensource | org licenses bsd
isc | 5 | permission | to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 4 | isc | licen[cs]e
isc | 3 | opensource | org licenses isc
ntp | 4 | ntp | licen[cs]e
hpnd | 4 | historical | permission notice and disclaimer
hpnd | 4 | hpnd |
mpl-1.0 | 4 | mozilla | public license (?:version |v )?v?1 0
mpl-1.1 | 4 | mozilla | public license (?:version |v )?v?1 1
mpl-2.0 | 4 | mozilla | public license (?:version |v )?v?2(?: 0)?
mpl-2.0 | 5 | source | code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | 5 | contents | of this file are subject to the mozilla public license version 1 1
mpl-1.0 | 4 | mpl | 1 0
mpl-1.1 | 4 | mpl | 1 1
mpl-2.0 | 4 | mpl | (?:version )?v?2(?: 0)?
mpl-2.0-no-copyleft-exception | 4 | mpl | 2 0 no copyleft exception
mpl-2.0-no-copyleft-exception | 5 | source | code form is incompatible with secondary licenses
mpl | 3 | mozilla | public license
mpl-2.0 | 3 | mozilla | org (?:en us )?mpl 2 0
epl-1.0 | 4 | eclipse | public license (?:version |v )?v?1(?: 0)?
epl-2.0 | 4 | eclipse | public license (?:version |v )?v?2(?: 0)?
epl-1.0 | 4 | epl | v?1 0
epl-2.0 | 4 | epl | v?2 0
epl | 3 | eclipse | public license
edl-1.0 | 4 | eclipse | distribution license(?: (?:version |v )?1 0)?
cpl-1.0 | 4 | common | public license (?:version |v )?1 0
cpl-1.0 | 3 | common | public license
cpal-1.0 | 4 | common | public attribution license
cddl-1.0 | 4 | common | development and distribution license (?:version |v )?1 0
cddl-1.1 | 4 | common | development and distribution license (?:version |v )?1 1
cddl | 3 | common | development and distribution license
cddl-1.0 | 4 | cddl | (?:version )?1 0
cddl-1.1 | 4 | cddl | (?:version )?1 1
cddl | 3 | cddl | licen[cs]e
ipl-1.0 | 4 | ibm | public license
spl-1.0 | 4 | sun | public license
npl-1.1 | 4 | netscape | public license
apsl-2.0 | 4 | apple | public source license(?: (?:version )?2 0)?
qpl-1.0 | 4 | qpl | 1 0
osl-2.1 | 4 | open | software license (?:version |v )?2 1
osl-3.0 | 4 | open | software license (?:version |v )?3 0
osl | 3 | open | software license
afl-2.1 | 4 | academic | free license (?:version |v )?2 1
afl-3.0 | 4 | academic | free license (?:version |v )?3 0
afl | 3 | academic | free license
ecl-2.0 | 4 | educational | community license(?: (?:version )?2 0)?
eupl-1.1 | 4 | european | union public licen[cs]e (?:version |v )?1 1
eupl-1.2 | 4 | european | union public licen[cs]e (?:version |v )?1 2
eupl | 3 | european | union public licen[cs]e
eupl-1.1 | 4 | eupl | v?1 1
eupl-1.2 | 4 | eupl | v?1 2
artistic-1.0 | 4 | artistic | licen[cs]e (?:version |v )?1 0
artistic-2.0 | 4 | artistic | licen[cs]e (?:version |v )?2(?: 0)?
artistic-1.0 | 4 | artistic | 1 0
artistic-2.0 | 4 | artistic | 2 0
artistic | 3 | artistic | licen[cs]e
perl | 3 | perl | (?:itself|artistic licen[cs]e)
ruby | 4 | ruby | licen[cs]e
python-2.0 | 4 | python | software foundation license(?: (?:version )?2)?
python-2.0 | 4 | psf | (?:2 0|licen[cs]e)
php-3.01 | 4 | php | license (?:version )?3 01
php | 3 | php | license
zope-2.1 | 4 | zope | public license(?: (?:version )?2 1)?
zpl-2.1 | 4 | zpl | (?:version )?2 1
w3c | 4 | w3c | software (?:and document )?(?:notice and )?license
postgresql | 4 | postgresql | licen[cs]e
openssl | 4 | openssl | licen[cs]e
openldap | 4 | openldap | public license(?: (?:version )?2 8)?
curl | 4 | curl | licen[cs]e
unicode | 4 | unicode | (?:license|terms of use|dfs 201[56])
icu | 4 | icu | licen[cs]e
vim | 4 | vim | licen[cs]e
tcl | 4 | tcl | tk license
sleepycat | 4 | sleepycat | licen[cs]e
ncsa | 4 | university | of illinois (?:ncsa )?open source license
ncsa | 4 | ncsa | (?:open source )?license
libpng | 4 | libpng | licen[cs]e
zlib | 5 | altered | source versions must be plainly marked as such
zlib | 4 | zlib | (?:libpng )?licen[cs]e
ijg | 4 | independent | jpeg group
freetype | 4 | freetype | (?:project )?license
boost-1.0 | 4 | boost | software license(?: (?:version )?1 0)?
boost-1.0 | 4 | bsl | 1 0
boost-1.0 | 3 | boost | org license 1 0
unlicense | 5 | free | and unencumbered software released into the public domain
unlicense | 4 | unlicense |
unlicense | 3 | unlicense | org
wtfpl | 4 | wtfpl |
beerware | 4 | beer | ware license
beerware | 4 | beerware |
public-domain | 3 | dedicated,released,placed | (?:in|into|to) the public domain
public-domain | 2 | public | domain
json | 5 | software | shall be used for good not evil
json | 4 | json | license
ms-pl | 4 | microsoft | public license
ms-rl | 4 | microsoft | reciprocal license
ms-pl | 4 | ms | pl
ms-rl | 4 | ms | rl
cc0-1.0 | 5 | cc0 | 1 0 universal
cc0-1.0 | 4 | cc0 | (?:1 0|licen[cs]e|public domain dedication)
cc0-1.0 | 3 | cc0 |
cc0-1.0 | 4 | creative | commons (?:cc0|zero)(?: 1 0)?
cc0-1.0 | 3 | creativecommons | org publicdomain zero 1 0
public-domain-mark | 3 | creativecommons | org publicdomain mark 1 0
cc-by-1.0 | 4 | cc | by 1 0
cc-by-2.0 | 4 | cc | by 2 0
cc-by-2.5 | 4 | cc | by 2 5
cc-by-3.0 | 4 | cc | by 3(?: 0)?
cc-by-4.0 | 4 | cc | by 4(?: 0)?
cc-by-sa-2.0 | 4 | cc | by sa 2 0
cc-by-sa-2.5 | 4 | cc | by sa 2 5
cc-by-sa-3.0 | 4 | cc | by sa 3(?: 0)?
cc-by-sa-4.0 | 4 | cc | by sa 4(?: 0)?
cc-by-nc-2.0 | 4 | cc | by nc 2 0
cc-by-nc-3.0 | 4 | cc | by nc 3(?: 0)?
cc-by-nc-4.0 | 4 | cc | by nc 4(?: 0)?
cc-by-nd-3.0 | 4 | cc | by nd 3(?: 0)?
cc-by-nd-4.0 | 4 | cc | by nd 4(?: 0)?
cc-by-nc-sa-2.0 | 4 | cc | by nc sa 2 0
cc-by-nc-sa-3.0 | 4 | cc | by nc sa 3(?: 0)?
cc-by-nc-sa-4.0 | 4 | cc | by nc sa 4(?: 0)?
cc-by-nc-nd-3.0 | 4 | cc | by nc nd 3(?: 0)?
cc-by-nc-nd-4.0 | 4 | cc | by nc nd 4(?: 0)?
cc-by-sa | 3 | cc | by sa
cc-by-nc | 3 | cc | by nc
cc-by-nd | 3 | cc | by nd
cc-by-nc-sa | 3 | cc | by nc sa
cc-by-nc-nd | 3 | cc | by nc nd
cc-by-4.0 | 4 | creative | commons attribution (?:international )?4 0(?: international)?
cc-by-3.0 | 4 | creative | commons attribution 3 0(?: unported)?
cc-by-sa-4.0 | 4 | creative | commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0 | 4 | creative | commons attribution share ?alike 3 0(?: unported)?
cc-by-nc-4.0 | 4 | creative | commons attribution non ?commercial 4 0(?: international)?
cc-by-nc-3.0 | 4 | creative | commons attribution non ?commercial 3 0(?: unported)?
cc-by-nd-4.0 | 4 | creative | commons attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-sa-4.0 | 4 | creative | commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd-4.0 | 4 | creative | commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-sa | 3 | creative | commons attribution share ?alike
cc-by-nc | 3 | creative | commons attribution non ?commercial
cc-by-nd | 3 | creative | commons attribution no ?deriv(?:ative)?s
cc-by-nc-sa | 3 | creative | commons attribution non ?commercial share ?alike
cc-by-nc-nd | 3 | creative | commons attribution non ?commercial no ?deriv(?:ative)?s
cc-by | 3 | creative | commons attribution
creative-commons | 2 | creative | commons(?: licen[cs]e)?
cc-by-4.0 | 3 | creativecommons | org licenses by 4 0
cc-by-3.0 | 3 | creativecommons | org licenses by 3 0
cc-by-sa-4.0 | 3 | creativecommons | org licenses by sa 4 0
cc-by-sa-3.0 | 3 | creativecommons | org licenses by sa 3 0
cc-by-nc-4.0 | 3 | creativecommons | org licenses by nc 4 0
cc-by-nd-4.0 | 3 | creativecommons | org licenses by nd 4 0
cc-by-nc-sa-4.0 | 3 | creativecommons | org licenses by nc sa 4 0
cc-by-nc-nd-4.0 | 3 | creativecommons | org licenses by nc nd 4 0
creative-commons | 2 | creativecommons | org licenses
odbl-1.0 | 4 | open | database license(?: (?:v )?1 0)?
odbl-1.0 | 4 | odbl | (?:1 0|licen[cs]e)
odc-by-1.0 | 4 | open | data commons attribution license
pddl-1.0 | 4 | open | data commons public domain dedication
pddl-1.0 | 4 | pddl | (?:1 0|licen[cs]e)
cdla-permissive-2.0 | 4 | cdla | permissive (?:1|2) 0
cdla-sharing-1.0 | 4 | cdla | sharing 1 0
ogl-uk-3.0 | 4 | open | government licen[cs]e(?: v3(?: 0)?)?
etalab-2.0 | 4 | licence | ouverte(?: (?:version |v )?2 0)?
dl-de-by-2.0 | 4 | datenlizenz | deutschland namensnennung(?: version)?(?: 2 0)?
ofl-1.1 | 4 | sil | open font license(?: (?:version )?1 1)?
ofl-1.1 | 4 | ofl | 1 1
cern-ohl | 4 | cern | (?:open hardware licen[cs]e|ohl)
elastic-2.0 | 4 | elastic | license (?:version )?2 0
elastic | 3 | elastic | license
sspl-1.0 | 4 | server | side public license
sspl-1.0 | 4 | sspl |
busl-1.1 | 4 | business | source license(?: 1 1)?
polyform | 4 | polyform | (?:noncommercial|small business|shield|strict|perimeter)(?: license)?
commons-clause | 4 | commons | clause (?:license )?condition
openrail | 4 | openrail |
openrail | 4 | bigscience | (?:bloom )?(?:rail|openrail)
gemma-terms | 4 | gemma | terms of use
llama-community | 4 | llama | (?:2 |3 )?community license
rail | 4 | responsible | ai licen[cs]e
proprietary | 3 | proprietary | and confidential
proprietary | 3 | unauthorized | (?:copying|reproduction|distribution|use) (?:of this (?:file|software|work) )?(?:via any medium )?is strictly prohibited
proprietary | 2 | confidential | and proprietary
reserved | 2 | rights | reserved
reserved | 3 | alle | rechte vorbehalten
reserved | 3 | tous | droits r[ée]serv[ée]s
reserved | 3 | todos | los derechos reservados
copyright | 1 | copyright | (?:c )?(?:19|20)\d\d
copyright | 1 | copyright | c
copyright | 1 | copyrighted | (?:material|work|by)
spdx | 2 | spdx | license identifier
licensed | 1 | licensed | under
licensed | 1 | license | (?:agreement|terms|text)
dual-license | 2 | dual,dually | (?:licensed|license)
permission-required | 2 | reprinted | (?:with|by) permission
non-commercial | 2 | non | commercial use only
non-commercial | 2 | personal | (?:and )?non ?commercial use
research-only | 2 | research | (?:purposes|use) only
educational-only | 2 | educational | (?:purposes|use) only
"""

#: Phrases whose places are counted in any case, and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
