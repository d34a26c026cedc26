"""Signature rules of licences, written by hand: level, label, keyword and pattern of each, in order of precedence within a level.

A pattern is matched against the lower-cased words of a text, joined by one space, from the begin of a word to the end of one. Levels:
1 sentences of a licence or of its notice, 2 identifiers and addresses, 3 names with a version, 4 names of a family and mentions.
A rule is tried only on texts that hold its keyword (one of those between bars) as a word.
"""

from __future__ import annotations

#: Phrases that are always reported, wherever they stand.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

RULES = r"""
1 apache-2.0      apache          licensed under the apache license version 2 0
1 apache-2.0      apache          apache license version 2 0 january 2004
1 apache-2.0      apache          may not use this file except in compliance with the license you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses license 2 0
1 apache-2.0      apache          (?:released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?apache (?:software )?(?:license|licence) (?:version |v)?2(?: 0)?
1 apache-1.1      apache          the apache software license version 1 1
1 apache-1.1      apache          this product includes software developed by the apache software foundation
1 apache-1.0      apache          this product includes software developed by the apache group for use in the apache http server project
1 mit             license|licence (?:released|licensed|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the )?mit (?:license|licence)
1 mit             permission      permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
1 mit             copyright       the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
1 mit-0           attribution     mit no attribution
1 mit-modern      permission      permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute this software
1 warranty-as-is  warranty        the software is provided as is without warranty of any kind express or implied
1 isc             permission      permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
1 isc             warranties      the software is provided as is and the author disclaims all warranties with regard to this software
1 isc             isc             (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?isc (?:license|licence)
1 bsd             redistribution  redistribution and use in source and binary forms with or without modification are permitted
1 bsd             redistributions redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
1 bsd             redistributions redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
1 bsd-3-clause    endorse         neither the name (?:of )?(?:\S+ ){1,12}?nor the names of its contributors may be used to endorse or promote products derived from this software
1 bsd-4-clause    advertising     all advertising materials mentioning features or use of this software must display the following acknowledgement
1 bsd-2-clause    bsd|freebsd|0bsd (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:simplified|2 clause|two clause|freebsd) bsd (?:license|licence)
1 bsd-3-clause    bsd             (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?(?:new|modified|revised|3 clause|three clause) bsd (?:license|licence)
1 bsd             bsd             (?:released|licensed|distributed|available|published|governed) (?:under|by) (?:the )?(?:terms of )?(?:a |the )?bsd (?:style )?(?:license|licence)
1 gpl-3.0         general         licensed under the (?:terms of the )?gnu general public license (?:as published by the free software foundation )?(?:version|v) ?3(?: 0)?
1 gpl-2.0         general         licensed under the (?:terms of the )?gnu general public license (?:as published by the free software foundation )?(?:version|v) ?2(?: 0)?
1 gpl-3.0+        general         under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
1 gpl-2.0+        general         under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
1 gpl-1.0+        general         under the terms of the gnu general public license as published by the free software foundation either version 1 (?:of the license )?or (?:at your option )?any later version
1 gpl-2.0         general         under the terms of (?:the )?gnu general public license version 2 (?:only )?as published by the free software foundation
1 gpl-3.0         general         under the terms of (?:the )?gnu general public license version 3 (?:only )?as published by the free software foundation
1 gpl-3.0         general         gnu general public license version 3 29 june 2007
1 gpl-2.0         general         gnu general public license version 2 june 1991
1 gpl             general         you should have received a copy of the gnu general public license along with this (?:program|software|library|file)
1 gpl             general         without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
1 lgpl-2.1+       lesser          under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
1 lgpl-3.0+       lesser          under the terms of the gnu lesser general public license as published by the free software foundation either version 3 (?:0 )?of the license or (?:at your option )?any later version
1 lgpl-2.0+       library         under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
1 lgpl-3.0        lesser          gnu lesser general public license version 3 29 june 2007
1 lgpl-2.1        lesser          gnu lesser general public license version 2 1 february 1999
1 lgpl            lesser          you should have received a copy of the gnu lesser general public license along with this (?:program|software|library|file)
1 agpl-3.0+       affero          under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
1 agpl-3.0        affero          gnu affero general public license version 3 19 november 2007
1 agpl-3.0        affero          licensed under the (?:terms of the )?gnu affero general public license (?:version|v) ?3(?: 0)?
1 agpl            affero          you should have received a copy of the gnu affero general public license along with this (?:program|software|file)
1 gfdl-1.3        documentation   permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 3
1 gfdl-1.2        documentation   permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license version 1 2
1 gfdl            documentation   permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
1 mpl-2.0         mozilla         this source code form is subject to the terms of the mozilla public license v 2 0
1 mpl-1.1         mozilla         the contents of this file are subject to the mozilla public license version 1 1
1 mpl-1.0         mozilla         the contents of this file are subject to the mozilla public license version 1 0
1 epl-2.0         eclipse         made available under the terms of the eclipse public license (?:v|version) ?2 0
1 epl-1.0         eclipse         made available under the terms of the eclipse public license (?:v|version) ?1 0
1 edl-1.0         eclipse         made available under the terms of the eclipse distribution license (?:v|version) ?1 0
1 cddl-1.0        distribution    the contents of this file are subject to the terms of the common development and distribution license
1 cpl-1.0         common          made available under the terms of the common public license (?:v|version) ?1 0
1 eupl-1.2        eupl            licensed under the eupl (?:version )?1 2
1 eupl-1.1        eupl            licensed under the eupl (?:version )?1 1
1 ms-pl           microsoft       (?:licensed|released|distributed) under the microsoft public license
1 ms-rl           microsoft       (?:licensed|released|distributed) under the microsoft reciprocal license
1 artistic-2.0    artistic        (?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the )?artistic license (?:version |v )?2 0
1 perl            perl            under the same terms as perl(?: 5)? itself
1 zlib            altered         altered source versions must be plainly marked as such and must not be misrepresented as being the original software
1 zlib            warranty        this software is provided as is without any express or implied warranty in no event will the authors be held liable
1 bsl-1.0         boost           distributed under the boost software license version 1 0
1 bsl-1.0         boost           boost software license version 1 0 august 17th 2003
1 unlicense       domain          this is free and unencumbered software released into the public domain
1 wtfpl           want            do what the \S+ you want to public license
1 wtfpl           wtfpl           (?:licensed|released|distributed) under the wtfpl
1 cc0-1.0         cc0             (?:licensed|released|dedicated|available|published) (?:under|to) (?:the )?(?:creative commons )?cc0(?: 1 0)?
1 cc0-1.0         waived          has waived all copyright and related or neighboring rights
1 cc-by-nc-nd-4.0 cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc nd 4 0
1 cc-by-nc-sa-4.0 cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc sa 4 0
1 cc-by-nc-4.0    cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nc 4 0
1 cc-by-nd-4.0    cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by nd 4 0
1 cc-by-sa-4.0    cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by sa 4 0
1 cc-by-sa-3.0    cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by sa 3 0
1 cc-by-4.0       cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by 4 0
1 cc-by-3.0       cc              (?:licensed|released|distributed|available|published) under (?:a |the )?cc by 3 0
1 cc-by-nc-nd     commons         creative commons attribution non ?commercial no ?deriv(?:s|atives|ative works)(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 cc-by-nc-sa     commons         creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 cc-by-nc        commons         creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 cc-by-nd        commons         creative commons attribution no ?deriv(?:s|atives)(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 cc-by-sa        commons         creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 cc-by           commons         creative commons attribution(?: [1-4] [05])?(?: international| unported)? (?:public )?(?:license|licence)
1 odbl-1.0        database        made available under the open database license
1 odc-by-1.0      commons         made available under the open data commons attribution license
1 pddl-1.0        domain          made available under the public domain dedication and license(?: v1 0)?
1 ofl-1.1         font            this font software is licensed under the sil open font license version 1 1
1 ofl-1.1         font            sil open font license version 1 1 26 february 2007
1 bsl-1.1         business        business source license 1 1
1 sspl-1.0        server          server side public license version 1
1 elastic-2.0     elastic         elastic license 2 0
1 psf-2.0         python          python software foundation license version 2
1 php-3.01        php             the php license version 3 01
1 ncsa            ncsa            university of illinois ncsa open source license
1 w3c             w3c             w3c software (?:and document )?(?:notice and )?license
1 x11             consortium      except as contained in this notice the name of the x consortium shall not be used in advertising
1 postgresql      postgresql      (?:released|licensed|distributed) under the postgresql (?:license|licence)
1 openssl         openssl         this product includes software developed by the openssl project
1 proprietary     proprietary     (?:confidential and proprietary|proprietary and confidential)(?: information)?
1 proprietary     reproduced      no part of this (?:publication|book|work|document|site|page) may be reproduced
1 proprietary     without         (?:may not be|must not be) (?:copied|reproduced|republished|redistributed)(?: \S+){0,6}? without (?:the )?(?:prior |express )?(?:written )?(?:permission|consent)
1 proprietary     unauthorized    unauthorized (?:copying|use|reproduction|distribution)(?: \S+){0,8}? (?:is )?(?:strictly )?prohibited
1 proprietary     redistributed   (?:published|broadcast|rewritten|redistributed) or redistributed without permission
1 proprietary     agreement       end user license agreement
1 proprietary     eula            eula
1 crown           government      contains public sector information licensed under the open government (?:license|licence) v(?:ersion )?[123](?: 0)?
2 apache-2.0      apache          (?:https? )?(?:www )?apache org licenses license 2 0(?: txt| html)?
2 apache-2.0      opensource      (?:https? )?(?:www )?opensource org licenses apache 2 0(?: php| html)?
2 mit             opensource      (?:https? )?(?:www )?opensource org licenses mit(?: license)?(?: php| html)?
2 bsd-2-clause    opensource      (?:https? )?(?:www )?opensource org licenses bsd 2 clause
2 bsd-3-clause    opensource      (?:https? )?(?:www )?opensource org licenses bsd 3 clause
2 bsd             opensource      (?:https? )?(?:www )?opensource org licenses bsd license(?: php)?
2 isc             opensource      (?:https? )?(?:www )?opensource org licenses isc(?: license)?(?: txt)?
2 gpl-3.0         gnu             (?:https? )?(?:www )?gnu org licenses (?:old licenses )?gpl 3 0(?: en)?(?: html| txt)?
2 gpl-2.0         gnu             (?:https? )?(?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
2 gpl             gnu             (?:https? )?(?:www )?gnu org (?:licenses|copyleft) gpl(?: html| txt)?
2 lgpl-3.0        gnu             (?:https? )?(?:www )?gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?
2 lgpl-2.1        gnu             (?:https? )?(?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
2 lgpl            gnu             (?:https? )?(?:www )?gnu org (?:licenses|copyleft) (?:lgpl|lesser)(?: html| txt)?
2 agpl-3.0        gnu             (?:https? )?(?:www )?gnu org licenses agpl(?: 3 0)?(?: en)?(?: html| txt)?
2 gfdl            gnu             (?:https? )?(?:www )?gnu org (?:licenses|copyleft) fdl(?: 1 [123])?(?: html| txt)?
2 mpl-2.0         mozilla         (?:https? )?(?:www )?mozilla org (?:en us )?mpl 2 0
2 mpl-1.1         mozilla         (?:https? )?(?:www )?mozilla org mpl (?:mpl 1 1|1 1)(?: html)?
2 epl-2.0         eclipse         (?:https? )?(?:www )?eclipse org (?:legal )?epl (?:2 0|v20)(?: html)?
2 epl-1.0         eclipse         (?:https? )?(?:www )?eclipse org (?:legal )?epl v10(?: html)?
2 bsl-1.0         boost           (?:https? )?(?:www )?boost org license 1 0 txt
2 unlicense       unlicense       (?:https? )?(?:www )?unlicense org
2 wtfpl           wtfpl           (?:https? )?(?:www )?wtfpl net
2 ofl-1.1         sil             (?:https? )?scripts sil org ofl
2 cc0-1.0         creativecommons (?:https? )?(?:www )?creativecommons org publicdomain zero 1 0
2 cc-pdm-1.0      creativecommons (?:https? )?(?:www )?creativecommons org publicdomain mark 1 0
2 cc-by-nc-nd-4.0 creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc nd 4 0
2 cc-by-nc-nd-3.0 creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc nd 3 0
2 cc-by-nc-nd     creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc nd
2 cc-by-nc-sa-4.0 creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc sa 4 0
2 cc-by-nc-sa-3.0 creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc sa 3 0
2 cc-by-nc-sa     creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc sa
2 cc-by-nc-4.0    creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc 4 0
2 cc-by-nc-3.0    creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc 3 0
2 cc-by-nc        creativecommons (?:https? )?(?:www )?creativecommons org licenses by nc
2 cc-by-nd-4.0    creativecommons (?:https? )?(?:www )?creativecommons org licenses by nd 4 0
2 cc-by-nd        creativecommons (?:https? )?(?:www )?creativecommons org licenses by nd
2 cc-by-sa-4.0    creativecommons (?:https? )?(?:www )?creativecommons org licenses by sa 4 0
2 cc-by-sa-3.0    creativecommons (?:https? )?(?:www )?creativecommons org licenses by sa 3 0
2 cc-by-sa        creativecommons (?:https? )?(?:www )?creativecommons org licenses by sa
2 cc-by-4.0       creativecommons (?:https? )?(?:www )?creativecommons org licenses by 4 0
2 cc-by-3.0       creativecommons (?:https? )?(?:www )?creativecommons org licenses by 3 0
2 cc-by-2.0       creativecommons (?:https? )?(?:www )?creativecommons org licenses by 2 0
2 cc-by           creativecommons (?:https? )?(?:www )?creativecommons org licenses by
2 odbl-1.0        opendatacommons (?:https? )?(?:www )?opendatacommons org licenses odbl(?: 1 0)?
2 odc-by-1.0      opendatacommons (?:https? )?(?:www )?opendatacommons org licenses by(?: 1 0)?
2 pddl-1.0        opendatacommons (?:https? )?(?:www )?opendatacommons org licenses pddl(?: 1 0)?
2 crown           nationalarchives (?:https? )?(?:www )?nationalarchives gov uk doc open government licence(?: version [123])?
3 apache-2.0      apache          apache (?:software )?(?:license|licence) (?:version |v )?2(?: 0)?
3 apache-2.0      apache          apache (?:2 0|v2) (?:license|licence)
3 apache-1.1      apache          apache (?:software )?(?:license|licence) (?:version |v )?1 1
3 gpl-3.0+        gpl             gpl (?:v)?3(?: 0)? (?:or later|plus)
3 gpl-2.0+        gpl             gpl (?:v)?2(?: 0)? (?:or later|plus)
3 gpl-3.0         gplv3           (?:gnu )?gplv3
3 gpl-2.0         gplv2           (?:gnu )?gplv2
3 gpl-3.0         gpl             (?:gnu )?gpl (?:version )?(?:v )?3(?: 0)?
3 gpl-2.0         gpl             (?:gnu )?gpl (?:version )?(?:v )?2(?: 0)?
3 gpl-3.0         general         (?:gnu )?general public license (?:version |v )?(?:3|v3)(?: 0)?
3 gpl-2.0         general         (?:gnu )?general public license (?:version |v )?(?:2|v2)(?: 0)?
3 lgpl-3.0        lgplv3          (?:gnu )?lgplv3
3 lgpl-2.1        lgpl            (?:gnu )?lgpl (?:version )?(?:v )?2 1
3 lgpl-3.0        lgpl            (?:gnu )?lgpl (?:version )?(?:v )?3(?: 0)?
3 lgpl-3.0        lesser          (?:gnu )?lesser general public license (?:version |v )?(?:3|v3)(?: 0)?
3 lgpl-2.1        lesser          (?:gnu )?lesser general public license (?:version |v )?2 1
3 agpl-3.0        agplv3          (?:gnu )?agplv3
3 agpl-3.0        agpl            (?:gnu )?agpl (?:version )?(?:v )?3(?: 0)?
3 agpl-3.0        affero          (?:gnu )?affero general public license (?:version |v )?(?:3|v3)(?: 0)?
3 mpl-2.0         mozilla         mozilla public license (?:version |v )?2 0
3 mpl-2.0         mpl             mpl (?:version |v )?2 0
3 mpl-1.1         mozilla         mozilla public license (?:version |v )?1 1
3 epl-2.0         eclipse         eclipse public license (?:version |v )?2 0
3 epl-1.0         eclipse         eclipse public license (?:version |v )?1 0
3 bsd-2-clause    bsd|freebsd|0bsd (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: license| licence)?
3 bsd-3-clause    bsd             (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: license| licence)?
3 bsd-4-clause    bsd             (?:bsd 4 clause|4 clause bsd|original bsd)(?: license| licence)?
3 bsd-0-clause    bsd|freebsd|0bsd (?:0bsd|zero clause bsd|bsd zero clause)(?: license| licence)?
3 artistic-2.0    artistic        artistic (?:license|licence) (?:version |v )?2 0
3 artistic-1.0    artistic        artistic (?:license|licence) (?:version |v )?1 0
3 afl-3.0         academic        academic free license (?:version |v )?3 0
3 osl-3.0         license         open software license (?:version |v )?3 0
3 cecill-2.1      cecill          cecill (?:version |v )?2 1
3 cecill-b        cecill          cecill b(?: license| licence)?
3 lppl-1.3c       latex           latex project public license (?:version |v )?1 3c
3 gfdl-1.3        documentation   (?:gnu )?free documentation license (?:version |v )?1 3
3 ofl-1.1         font            (?:sil )?open font license (?:version |v )?1 1
3 cc0-1.0         cc0             (?:creative commons )?cc0 1 0(?: universal)?
3 cc-by-nc-nd-4.0 cc              cc by nc nd 4 0
3 cc-by-nc-sa-4.0 cc              cc by nc sa 4 0
3 cc-by-nc-sa-3.0 cc              cc by nc sa 3 0
3 cc-by-nc-4.0    cc              cc by nc 4 0
3 cc-by-nc-3.0    cc              cc by nc 3 0
3 cc-by-nd-4.0    cc              cc by nd 4 0
3 cc-by-sa-4.0    cc              cc by sa 4 0
3 cc-by-sa-3.0    cc              cc by sa 3 0
3 cc-by-sa-2.5    cc              cc by sa 2 5
3 cc-by-4.0       cc              cc by 4 0
3 cc-by-3.0       cc              cc by 3 0
3 cc-by-2.5       cc              cc by 2 5
3 cc-by-2.0       cc              cc by 2 0
4 apache          apache          apache (?:software )?(?:license|licence)
4 mit             license|licence mit (?:license|licence)
4 mit             licensed        mit licensed
4 isc             isc             isc (?:license|licence)
4 bsd             bsd             bsd (?:style )?(?:license|licence|licensed)
4 gpl             gpl             (?:gnu )?gpl (?:license|licence|licensed|compatible)
4 gpl             general         gnu general public (?:license|licence)
4 lgpl            lgpl            (?:gnu )?lgpl (?:license|licence|licensed)
4 lgpl            lesser          (?:gnu )?lesser general public (?:license|licence)
4 agpl            affero          (?:gnu )?affero general public (?:license|licence)
4 gfdl            documentation   (?:gnu )?free documentation (?:license|licence)
4 mpl             mozilla         mozilla public (?:license|licence)
4 epl             eclipse         eclipse public (?:license|licence)
4 cddl            common          common development and distribution (?:license|licence)
4 eupl            european        european union public (?:license|licence)
4 ms-pl           microsoft       microsoft public (?:license|licence)
4 artistic        artistic        artistic (?:license|licence)
4 zlib            zlib            zlib (?:libpng )?(?:license|licence)
4 bsl-1.0         boost           boost software (?:license|licence)
4 unlicense       unlicense       the unlicense
4 cc0             cc0             cc0
4 cc-by-nc-nd     cc              cc by nc nd
4 cc-by-nc-sa     cc              cc by nc sa
4 cc-by-nc        cc              cc by nc
4 cc-by-nd        cc              cc by nd
4 cc-by-sa        cc              cc by sa
4 creative-commons commons         creative commons(?: public)? (?:license|licence|licensed)
4 odbl            database        open database (?:license|licence)
4 ofl             font            open font (?:license|licence)
4 crown           crown           crown copyright
4 crown           government      open government (?:license|licence)
4 public-domain   domain          (?:in|into|to) the public domain
4 public-domain   domain          public domain (?:work|dedication|mark)
4 reserved        reserved        (?:some|no) rights reserved
4 reserved        rechte          alle rechte vorbehalten
4 reserved        droits          tous droits réservés
4 reserved        derechos        todos los derechos reservados
4 reserved        direitos        todos os direitos reservados
4 reserved        diritti         tutti i diritti riservati
4 reserved        rechten         alle rechten voorbehouden
4 copyright       copyright       copyright (?:c |© )?(?:by )?(?:19|20)\d\d(?: (?:19|20)\d\d)?
4 copyright       copyright       copyright (?:c|©|by|holders?|notice|owners?)
4 copyright       ©               © (?:19|20)\d\d
4 proprietary     proprietary     proprietary (?:license|licence|software)
4 commercial      commercial      commercial (?:license|licence)
4 free            royalty         royalty free (?:license|licence)
4 open-source     source          open source (?:license|licence|licensed)
4 license         licensed        licensed under (?:the )?(?:same |following )?(?:terms|license|licence)
4 license         license         see (?:the )?license (?:file )?for (?:details|more information|terms)
4 license         licence         see (?:the )?licence (?:file )?for (?:details|more information|terms)
4 license         licensed        all content (?:on this (?:site|page) )?is licensed
4 license         licencia        bajo (?:la|una) licencia
4 license         licence         sous (?:la )?licence
4 license         lizenz          unter (?:der|einer) (?:\S+ )?lizenz
"""

#: Identifiers of licences, each sought behind its tag "SPDX-License-Identifier:" too, under its own name in lower case.
IDENTIFIERS = """
0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause
BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1
CECILL-2.1 CPL-1.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.2-only GFDL-1.3-only GPL-1.0-only GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0
GPL-3.0-only GPL-3.0-or-later ISC LGPL-2.0-only LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0
MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PDDL-1.0 PHP-3.01 PostgreSQL PSF-2.0 SSPL-1.0 Unlicense UPL-1.0 W3C WTFPL X11 Zlib
"""


def rules() -> list[tuple[int, str, str, str]]:
    """(level, label, keyword, pattern) of all rules, base phrases first, at level 0."""
    out = [(0, label, phrase.split()[0], phrase) for phrase, label in BASE.items()]
    for line in RULES.strip().split("\n"):
        level, label, keyword, pattern = line.split(None, 3)
        out.append((int(level), label, keyword, pattern))
    for name in IDENTIFIERS.split():
        words = name.lower().replace("-", " ").replace(".", " ")
        out.append((1, name.lower(), "spdx", f"spdx license identifier {words}"))
    return out
