"""Signature rules of the license scan, one a line: tier, label, keyword, pattern.

Patterns are matched on words: A-Z lower-cased, words parted by one blank, so "Apache-2.0" reads "apache 2 0". They match
at word borders. The keyword is a plain text every match holds from a word's start; a rule is tried only where it occurs. Tiers:
0 sentences of a notice, 1 machine-readable tags and addresses, 2 names with a version or variant, 3 bare names.
"""

from __future__ import annotations

from typing import NamedTuple

TEXT = r"""
0 | mit | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
0 | mit | above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions
0 | mit | under the mit | (?:licensed|released|distributed|available|published|provided) under the (?:terms of the )?mit licen[sc]e
0 | mit | the mit license | (?:this (?:project|software|code|library|program|package|work) is )?(?:licensed|covered) (?:by|under) the mit license
0 | isc | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0 | isc | under the isc | (?:licensed|released|distributed|available) under the (?:terms of the )?isc licen[sc]e
0 | 0bsd | permission to use copy modify | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
0 | apache-2.0 | under the apache license | licensed under the apache license version 2 0(?: the license)?(?: you may not use this file except in compliance with the license)?
0 | apache-2.0 | apache license version 2 0 | (?:released|distributed|available|published|covered) (?:by|under) the (?:terms of the )?apache license version 2 0
0 | apache-2.0 | apache software foundation | licensed to the apache software foundation asf under one or more contributor license agreements
0 | apache-2.0 | obtain a copy of the license at | you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0
0 | apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
0 | gpl-1.0-or-later | free software you can redistribute | is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation
0 | gpl-2.0 | version 2 of the license | under the terms of the gnu general public license as published by the free software foundation version 2 of the license
0 | gpl-2.0-or-later | either version 2 of the license | under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
0 | gpl-3.0 | version 3 of the license | under the terms of the gnu general public license as published by the free software foundation version 3 of the license
0 | gpl-3.0-or-later | either version 3 of the license | under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
0 | gpl-3.0 | gnu general public license version 3 | (?:this \w+ is )?(?:licensed|released|distributed|available) under the gnu general public license version 3(?: 0)?
0 | gpl-2.0 | gnu general public license version 2 | (?:this \w+ is )?(?:licensed|released|distributed|available) under the gnu general public license version 2(?: 0)?
0 | gpl | gnu general public license for more details | see the gnu general public license for more details
0 | gpl | a copy of the gnu general public license | you should have received a copy of the gnu general public license along with this (?:program|software|library|file)
0 | lgpl-2.1 | gnu lesser general public license | under the terms of the gnu lesser general public license as published by the free software foundation version 2 1 of the license
0 | lgpl-2.1-or-later | gnu lesser general public license | under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
0 | lgpl-3.0 | gnu lesser general public license | under the terms of the gnu lesser general public license as published by the free software foundation version 3 of the license
0 | lgpl-3.0-or-later | gnu lesser general public license | under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
0 | lgpl | a copy of the gnu lesser general public license | you should have received a copy of the gnu lesser general public license along with this (?:program|software|library|file)
0 | lgpl-2.0-or-later | gnu library general public license | under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
0 | agpl-3.0 | gnu affero general public license | under the terms of the gnu affero general public license as published by the free software foundation version 3 of the license
0 | agpl-3.0-or-later | gnu affero general public license | under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
0 | agpl | a copy of the gnu affero general public license | you should have received a copy of the gnu affero general public license along with this (?:program|software|library|file)
0 | gfdl-1.1 | gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 1
0 | gfdl-1.2 | gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
0 | gfdl-1.3 | gnu free documentation license | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
0 | bsd | redistribution and use in source and binary | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
0 | bsd-2-clause | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution
0 | bsd-3-clause | endorse or promote products | may be used to endorse or promote products derived from this software without specific prior written permission
0 | bsd-4-clause | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
0 | bsd | under the bsd | (?:licensed|released|distributed|available) under the (?:terms of the )?(?:new |modified |simplified |revised )?bsd licen[sc]e
0 | bsd | bsd style license | use of this source code is governed by a bsd style license
0 | mpl-1.1 | mozilla public license version 1 1 | the contents of this file are subject to the mozilla public license version 1 1
0 | mpl-2.0 | mozilla public license v | this source code form is subject to the terms of the mozilla public license v 2 0
0 | mpl-2.0 | a copy of the mpl | if a copy of the mpl was not distributed with this file you can obtain one at
0 | npl-1.1 | netscape public license | the contents of this file are subject to the netscape public license version 1 1
0 | epl-1.0 | eclipse public license | made available under the terms of the eclipse public license v1 0
0 | epl-2.0 | eclipse public license | made available under the terms of the eclipse public license (?:v|v 2 0|v2 0|version 2 0|2 0)
0 | cddl-1.0 | common development and distribution license | subject to the terms of the common development and distribution license(?: version 1 0)?(?: only)?
0 | cpl-1.0 | common public license | made available under the terms of the common public license v1 0
0 | zlib | provided as is without any express or implied | this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
0 | zlib | altered source versions must | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
0 | bsl-1.0 | boost software license | distributed under the boost software license version 1 0
0 | bsl-1.0 | permission is hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license
0 | unlicense | released into the public domain | this is free and unencumbered software released into the public domain
0 | unlicense | free to copy modify publish | anyone is free to copy modify publish use compile sell or distribute this software
0 | wtfpl | do what the fuck you want to | you just do what the fuck you want to
0 | cc0-1.0 | no copyright | the person who associated a work with this deed has dedicated the work to the public domain
0 | cc0-1.0 | waived all copyright | (?:the author|the authors|\w+) has waived all copyright and related (?:or|and) neighboring rights
0 | public-domain | public domain | (?:is|has been|was|are) (?:hereby )?(?:placed|released|dedicated|put) (?:in|into|to) the public domain
0 | public-domain | in the public domain | this (?:work|file|code|text|image|software) is in the public domain
0 | cc-by | creative commons attribution | (?:licensed|released|available|distributed|published) under (?:a|the) (?:terms of the )?creative commons attribution (?:\d \d )?(?:international |unported |generic )?licen[sc]e
0 | cc-by-sa | creative commons attribution share | (?:licensed|released|available|distributed|published) under (?:a|the) (?:terms of the )?creative commons attribution share ?alike (?:\d \d )?(?:international |unported |generic )?licen[sc]e
0 | cc-by-nc | creative commons attribution non | (?:licensed|released|available|distributed|published) under (?:a|the) (?:terms of the )?creative commons attribution non ?commercial (?:\d \d )?(?:international |unported |generic )?licen[sc]e
0 | ofl-1.1 | sil open font license | this font software is licensed under the sil open font license version 1 1
0 | artistic-2.0 | artistic license | (?:licensed|released|distributed|available) under the (?:terms of the )?artistic license 2 0
0 | perl | same terms as perl | this (?:library|program|module) is free software you can redistribute it and or modify it under the same terms as perl itself
0 | python-2.0 | python software foundation | this license agreement is between the python software foundation psf and the individual or organization
0 | php-3.01 | php license | this source file is subject to version 3 01 of the php license
0 | php-3.0 | php license | this source file is subject to version 3 0 of the php license
0 | zpl-2.1 | zope public license | this software is subject to the provisions of the zope public license version 2 1
0 | eupl-1.1 | european union public licence | licensed under the eupl version 1 1|european union public licence v 1 1
0 | eupl-1.2 | european union public licence | european union public licence v 1 2
0 | ms-pl | microsoft public license | (?:licensed|released|distributed|subject) (?:under|to) the microsoft public license
0 | openssl | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
0 | ncsa | university of illinois | (?:distributed|released) under the university of illinois open source license
0 | hpnd | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted
0 | x11 | x consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
0 | elastic-2.0 | elastic license | licensed under the elastic license(?: 2 0| version 2 0)?
0 | sspl-1.0 | server side public license | under the terms of the server side public license version 1
0 | busl-1.1 | business source license | use of this software is governed by the business source license
0 | proprietary | all rights reserved | (?:confidential|proprietary)(?: and (?:confidential|proprietary))? all rights reserved
0 | proprietary | unauthorized copying | unauthorized copying of this (?:file|software|work|document) (?:via any medium )?is strictly prohibited
0 | odbl-1.0 | open database license | (?:licensed|released|available|made available) under the open (?:data commons )?(?:open )?database license
0 | odc-by-1.0 | open data commons attribution | (?:licensed|released|available|made available) under the open data commons attribution license
1 | mit | spdx license identifier | spdx license identifier mit
1 | mit-0 | spdx license identifier | spdx license identifier mit 0
1 | isc | spdx license identifier | spdx license identifier isc
1 | 0bsd | spdx license identifier | spdx license identifier 0bsd
1 | apache-1.1 | spdx license identifier | spdx license identifier apache 1 1
1 | apache-2.0 | spdx license identifier | spdx license identifier apache 2 0
1 | gpl-1.0 | spdx license identifier | spdx license identifier gpl 1 0(?: only)?
1 | gpl-2.0 | spdx license identifier | spdx license identifier gpl 2 0(?: only)?
1 | gpl-2.0-or-later | spdx license identifier | spdx license identifier gpl 2 0 or later
1 | gpl-3.0 | spdx license identifier | spdx license identifier gpl 3 0(?: only)?
1 | gpl-3.0-or-later | spdx license identifier | spdx license identifier gpl 3 0 or later
1 | lgpl-2.0 | spdx license identifier | spdx license identifier lgpl 2 0(?: only)?
1 | lgpl-2.1 | spdx license identifier | spdx license identifier lgpl 2 1(?: only)?
1 | lgpl-2.1-or-later | spdx license identifier | spdx license identifier lgpl 2 1 or later
1 | lgpl-3.0 | spdx license identifier | spdx license identifier lgpl 3 0(?: only)?
1 | lgpl-3.0-or-later | spdx license identifier | spdx license identifier lgpl 3 0 or later
1 | agpl-3.0 | spdx license identifier | spdx license identifier agpl 3 0(?: only)?
1 | agpl-3.0-or-later | spdx license identifier | spdx license identifier agpl 3 0 or later
1 | bsd-1-clause | spdx license identifier | spdx license identifier bsd 1 clause
1 | bsd-2-clause | spdx license identifier | spdx license identifier bsd 2 clause
1 | bsd-3-clause | spdx license identifier | spdx license identifier bsd 3 clause
1 | bsd-4-clause | spdx license identifier | spdx license identifier bsd 4 clause
1 | mpl-1.1 | spdx license identifier | spdx license identifier mpl 1 1
1 | mpl-2.0 | spdx license identifier | spdx license identifier mpl 2 0
1 | epl-1.0 | spdx license identifier | spdx license identifier epl 1 0
1 | epl-2.0 | spdx license identifier | spdx license identifier epl 2 0
1 | cddl-1.0 | spdx license identifier | spdx license identifier cddl 1 0
1 | zlib | spdx license identifier | spdx license identifier zlib
1 | bsl-1.0 | spdx license identifier | spdx license identifier bsl 1 0
1 | unlicense | spdx license identifier | spdx license identifier unlicense
1 | wtfpl | spdx license identifier | spdx license identifier wtfpl
1 | cc0-1.0 | spdx license identifier | spdx license identifier cc0 1 0
1 | cc-by-4.0 | spdx license identifier | spdx license identifier cc by 4 0
1 | cc-by-sa-4.0 | spdx license identifier | spdx license identifier cc by sa 4 0
1 | ofl-1.1 | spdx license identifier | spdx license identifier ofl 1 1
1 | artistic-2.0 | spdx license identifier | spdx license identifier artistic 2 0
1 | eupl-1.2 | spdx license identifier | spdx license identifier eupl 1 2
1 | upl-1.0 | spdx license identifier | spdx license identifier upl 1 0
1 | mit | opensource org | opensource org licenses? mit(?: license)?
1 | isc | opensource org | opensource org licenses? isc(?: license)?
1 | bsd | opensource org | opensource org licenses? bsd(?: license)?
1 | bsd-2-clause | opensource org | opensource org licenses? bsd 2 clause
1 | bsd-3-clause | opensource org | opensource org licenses? bsd 3 clause
1 | apache-2.0 | opensource org | opensource org licenses? apache 2 0
1 | apache-2.0 | apache org | (?:www )?apache org licenses license 2 0
1 | gpl | gnu org | (?:www )?gnu org licenses gpl(?: html| txt)?
1 | gpl-2.0 | gnu org | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0
1 | gpl-3.0 | gnu org | (?:www )?gnu org licenses gpl 3 0
1 | lgpl | gnu org | (?:www )?gnu org licenses lgpl(?: html| txt)?
1 | lgpl-2.1 | gnu org | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1
1 | lgpl-3.0 | gnu org | (?:www )?gnu org licenses lgpl 3 0
1 | agpl-3.0 | gnu org | (?:www )?gnu org licenses agpl(?: 3 0)?
1 | gfdl | gnu org | (?:www )?gnu org (?:licenses fdl|copyleft fdl)
1 | mpl-2.0 | mozilla org | (?:www )?mozilla org mpl 2 0
1 | mpl-1.1 | mozilla org | (?:www )?mozilla org mpl (?:mpl 1 1|1 1)
1 | epl-1.0 | eclipse org | (?:www )?eclipse org legal epl v10
1 | epl-2.0 | eclipse org | (?:www )?eclipse org legal epl (?:2 0|v20)
1 | bsl-1.0 | boost org | (?:www )?boost org license 1 0
1 | unlicense | unlicense org | (?:www )?unlicense org
1 | wtfpl | wtfpl net | (?:www )?wtfpl net
1 | ofl-1.1 | scripts sil org | scripts sil org ofl
1 | cc0-1.0 | creativecommons org | creativecommons org publicdomain zero 1 0
1 | public-domain | creativecommons org | creativecommons org publicdomain mark 1 0
1 | cc-by-1.0 | creativecommons org | creativecommons org licenses by 1 0
1 | cc-by-2.0 | creativecommons org | creativecommons org licenses by 2 0
1 | cc-by-2.5 | creativecommons org | creativecommons org licenses by 2 5
1 | cc-by-3.0 | creativecommons org | creativecommons org licenses by 3 0
1 | cc-by-4.0 | creativecommons org | creativecommons org licenses by 4 0
1 | cc-by-sa-2.0 | creativecommons org | creativecommons org licenses by sa 2 0
1 | cc-by-sa-3.0 | creativecommons org | creativecommons org licenses by sa 3 0
1 | cc-by-sa-4.0 | creativecommons org | creativecommons org licenses by sa 4 0
1 | cc-by-nc-3.0 | creativecommons org | creativecommons org licenses by nc 3 0
1 | cc-by-nc-4.0 | creativecommons org | creativecommons org licenses by nc 4 0
1 | cc-by-nd-3.0 | creativecommons org | creativecommons org licenses by nd 3 0
1 | cc-by-nd-4.0 | creativecommons org | creativecommons org licenses by nd 4 0
1 | cc-by-nc-sa-3.0 | creativecommons org | creativecommons org licenses by nc sa 3 0
1 | cc-by-nc-sa-4.0 | creativecommons org | creativecommons org licenses by nc sa 4 0
1 | cc-by-nc-nd-3.0 | creativecommons org | creativecommons org licenses by nc nd 3 0
1 | cc-by-nc-nd-4.0 | creativecommons org | creativecommons org licenses by nc nd 4 0
2 | mit | mit license mit | the mit license mit
2 | mit | mit license | (?:the )?mit license
2 | mit-0 | mit no attribution | mit no attribution(?: license)?
2 | x11 | x11 license | (?:the )?x11 license
2 | isc | isc license | (?:the )?isc license
2 | apache-1.0 | apache license 1 0 | apache license 1 0
2 | apache-1.1 | apache | apache (?:software )?license (?:version )?1 1
2 | apache-2.0 | apache | apache (?:software )?license (?:version |v )?2(?: 0)?
2 | apache-2.0 | apache 2 0 | apache 2 0 licen[sc]ed?
2 | gpl-1.0 | gnu general public license | gnu general public license (?:version |v )1(?: 0)?
2 | gpl-2.0 | gnu general public license | gnu general public license (?:version |v )?2(?: 0)?
2 | gpl-3.0 | gnu general public license | gnu general public license (?:version |v )?3(?: 0)?
2 | gpl-2.0 | gpl | (?:gnu )?gpl ?v?2(?: 0)?
2 | gpl-3.0 | gpl | (?:gnu )?gpl ?v?3(?: 0)?
2 | gpl-2.0-or-later | gpl | (?:gnu )?gpl ?v?2 or (?:later|newer|above|any later version)
2 | gpl-3.0-or-later | gpl | (?:gnu )?gpl ?v?3 or (?:later|newer|above|any later version)
2 | lgpl-2.0 | gnu library general public license | gnu library general public license (?:version )?2(?: 0)?
2 | lgpl-2.1 | gnu lesser general public license | gnu lesser general public license (?:version |v )?2 1
2 | lgpl-3.0 | gnu lesser general public license | gnu lesser general public license (?:version |v )?3(?: 0)?
2 | lgpl-2.1 | lgpl | (?:gnu )?lgpl ?v?2 1
2 | lgpl-3.0 | lgpl | (?:gnu )?lgpl ?v?3(?: 0)?
2 | agpl-3.0 | gnu affero general public license | gnu affero general public license (?:version |v )?3(?: 0)?
2 | agpl-3.0 | agpl | (?:gnu )?agpl ?v?3(?: 0)?
2 | gfdl-1.3 | gnu free documentation license | gnu free documentation license (?:version )?1 3
2 | bsd-2-clause | bsd | (?:the )?(?:2 clause bsd|bsd 2 clause|simplified bsd|freebsd) license
2 | bsd-3-clause | bsd | (?:the )?(?:3 clause bsd|bsd 3 clause|new bsd|modified bsd|revised bsd) license
2 | bsd-4-clause | bsd | (?:the )?(?:4 clause bsd|bsd 4 clause|original bsd|old bsd) license
2 | mpl-1.0 | mozilla public license | mozilla public license (?:version |v )?1 0
2 | mpl-1.1 | mozilla public license | mozilla public license (?:version |v )?1 1
2 | mpl-2.0 | mozilla public license | mozilla public license (?:version |v )?2 0
2 | epl-1.0 | eclipse public license | eclipse public license (?:version |v )?1 0
2 | epl-2.0 | eclipse public license | eclipse public license (?:version |v )?2 0
2 | cddl-1.1 | common development and distribution license | common development and distribution license (?:version )?1 1
2 | bsl-1.0 | boost software license | boost software license (?:version )?1 0
2 | artistic-1.0 | artistic license | artistic license (?:version )?1 0
2 | artistic-2.0 | artistic license | artistic license (?:version )?2 0
2 | afl-3.0 | academic free license | academic free license (?:version |v )?3 0
2 | osl-3.0 | open software license | open software license (?:version |v )?3 0
2 | ofl-1.1 | sil open font license | sil open font license (?:version )?1 1
2 | zpl-2.1 | zope public license | zope public license zpl version 2 1
2 | eupl-1.2 | eupl | eupl (?:version |v )?1 2
2 | ms-rl | microsoft reciprocal license | microsoft reciprocal license(?: ms rl)?
2 | upl-1.0 | universal permissive license | universal permissive license(?: upl)?(?: version 1 0)?
2 | vim | vim license | (?:the )?vim license
2 | postgresql | postgresql license | (?:the )?postgresql licen[sc]e
2 | ruby | ruby license | (?:the )?ruby license
2 | lppl-1.3c | latex project public license | latex project public license (?:version )?1 3c?
2 | cecill-2.1 | cecill | cecill (?:free software license agreement )?(?:version |v )?2 1
2 | mulan-2.0 | mulan | mulan psl v2|mulan permissive software license version 2
2 | cc0-1.0 | cc0 | cc0 1 0(?: universal)?
2 | cc-by-2.0 | cc by 2 0 | cc by 2 0
2 | cc-by-2.5 | cc by 2 5 | cc by 2 5
2 | cc-by-3.0 | cc by 3 0 | cc by 3 0
2 | cc-by-4.0 | cc by 4 0 | cc by 4 0
2 | cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0
2 | cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0
2 | cc-by-nc-3.0 | cc by nc 3 0 | cc by nc 3 0
2 | cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0
2 | cc-by-nd-4.0 | cc by nd 4 0 | cc by nd 4 0
2 | cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0
2 | cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0
2 | cc-by-4.0 | creative commons attribution 4 0 | creative commons attribution 4 0(?: international)?(?: public)?(?: license)?
2 | cc-by-3.0 | creative commons attribution 3 0 | creative commons attribution 3 0(?: unported)?(?: license)?
2 | cc-by-sa-4.0 | creative commons attribution sharealike 4 0 | creative commons attribution sharealike 4 0(?: international)?(?: public)?(?: license)?
2 | cc-by-sa-3.0 | creative commons attribution sharealike 3 0 | creative commons attribution sharealike 3 0(?: unported)?(?: license)?
2 | cc-by-nc-4.0 | creative commons attribution noncommercial 4 0 | creative commons attribution noncommercial 4 0(?: international)?(?: public)?(?: license)?
2 | cc-by-nc-sa-4.0 | noncommercial sharealike 4 0 | creative commons attribution noncommercial sharealike 4 0(?: international)?(?: public)?(?: license)?
2 | cc-by-nc-nd-4.0 | noncommercial noderivatives 4 0 | creative commons attribution noncommercial noderivatives 4 0(?: international)?(?: public)?(?: license)?
2 | cc-by-nd-4.0 | creative commons attribution noderivatives 4 0 | creative commons attribution noderivatives 4 0(?: international)?(?: public)?(?: license)?
3 | gpl | gnu general public license | gnu general public licen[sc]e
3 | gpl | gpl | (?:gnu )?gpl
3 | lgpl | gnu lesser general public license | gnu lesser general public license
3 | lgpl | gnu library general public license | gnu library general public license
3 | lgpl | lgpl | (?:gnu )?lgpl
3 | agpl | gnu affero general public license | gnu affero general public license
3 | agpl | agpl | (?:gnu )?agpl
3 | gfdl | gnu free documentation license | gnu free documentation license
3 | apache | apache license | apache license
3 | bsd | bsd | (?:the )?bsd (?:style )?licen[sc]ed?
3 | mpl | mozilla public license | mozilla public license
3 | epl | eclipse public license | eclipse public license
3 | cddl | cddl | cddl
3 | cddl | common development and distribution license | common development and distribution license
3 | zlib | zlib license | (?:the )?zlib license
3 | bsl-1.0 | boost software license | boost software license
3 | artistic | artistic license | artistic license
3 | unlicense | unlicense | the unlicense
3 | wtfpl | wtfpl | wtfpl
3 | ofl | open font license | open font license
3 | python-2.0 | python software foundation license | python software foundation license
3 | ms-pl | microsoft public license | microsoft public license
3 | eupl | european union public licence | european union public licence
3 | cc0 | cc0 | cc0
3 | cc-by | cc by | cc by
3 | cc-by-sa | cc by sa | cc by sa
3 | cc-by-nc | cc by nc | cc by nc
3 | cc-by-nd | cc by nd | cc by nd
3 | cc-by-nc-sa | cc by nc sa | cc by nc sa
3 | cc-by-nc-nd | cc by nc nd | cc by nc nd
3 | cc-by | creative commons attribution | creative commons attribution
3 | cc | creative commons | creative commons licen[sc]ed?
3 | public-domain | public domain | public domain
3 | proprietary | all rights reserved | all rights reserved
3 | sspl | server side public license | server side public license
3 | busl | business source license | business source license
3 | odbl | open database license | open database license
"""

# every keyword, after a blank, holds one of these, so a text without any of them is left alone after a few searches
STEMS = (
    "licen", " gpl", " lgpl", " agpl", " permission", " redistribution", " public domain", " copyright", " all rights", " cc by", " cc0", " creative",
    " opensource org", " apache", " gnu org", " mozilla org", " eclipse org", " boost org", " wtfpl", " do what the fuck", " scripts sil",
    " a copy of the mpl", " bsd", " eupl", " cddl", " provided as is", " altered source", " all advertising", " endorse or promote", " same terms",
    " openssl toolkit", " x consortium", " university of illinois", " mulan", " cecill", " free software you", " free to copy",
    " unauthorized copying", " mit no attribution", " open data commons", " noncommercial", " python software", " under the mit", " under the isc",
)


class Rule(NamedTuple):
    tier: int
    label: str
    keyword: str
    pattern: str


def rules() -> list[Rule]:
    out = []
    for line in TEXT.strip().splitlines():
        tier, label, keyword, pattern = (x.strip() for x in line.split(" | ", 3))
        out.append(Rule(int(tier), label, f" {keyword}", pattern))
    return out
