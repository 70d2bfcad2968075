"""Signature rules of the license scan.

Fixed values, in the order of their priority within a tier. A line of ``LICENSES`` is: label, keyword
that every text of the name pattern holds (the pattern is tried only where it occurs), pattern of the name, pattern of the short
identifier, pattern of the address (``-`` for none). All are matched in lower-cased text.
"""

from __future__ import annotations

from typing import NamedTuple

LICENSES = r"""
apache-2.0 ; apache ; apache\s+(?:software\s+)?license,?\s+(?:version|v\.?)?\s*2(?:\.0)? ; apache-2\.0 ; apache\.org/licenses/license-2\.0
apache-1.1 ; apache ; apache\s+(?:software\s+)?license,?\s+(?:version|v\.?)?\s*1\.1 ; apache-1\.1 ; apache\.org/licenses/license-1\.1
apache ; apache ; apache\s+(?:software\s+)?license ; apache ; apache\.org/licenses
mit ; mit ; (?<![a-z])mit\s+licen[sc]e ; mit ; opensource\.org/licenses/mit
mit-0 ; mit ; (?<![a-z])mit\s+no\s+attribution ; mit-0 ; opensource\.org/licenses/mit-0
bsd-4-clause ; bsd ; (?:4|four)[-\s]clause\s+bsd(?:\s+licen[sc]e)? ; bsd-4-clause ; spdx\.org/licenses/bsd-4-clause
bsd-3-clause ; bsd ; (?:(?:3|three)[-\s]clause|new|modified)\s+bsd(?:\s+licen[sc]e)? ; bsd-3-clause ; opensource\.org/licenses/bsd-3-clause
bsd-2-clause ; bsd ; (?:(?:2|two)[-\s]clause|simplified|freebsd)\s+bsd(?:\s+licen[sc]e)? ; bsd-2-clause ; opensource\.org/licenses/bsd-2-clause
bsd ; bsd ; (?<![a-z])bsd[-\s]+(?:style\s+)?licen[sc]e ; bsd ; opensource\.org/licenses/bsd
agpl-3.0 ; affero ; (?:gnu\s+)?affero\s+general\s+public\s+licen[sc]e(?:,?\s+(?:version|v\.?)\s*3(?:\.0)?)? ; agpl-3\.0(?:-only|-or-later)? ; gnu\.org/licenses/agpl
lgpl-3.0 ; lesser ; (?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*3(?:\.0)? ; lgpl-3\.0(?:-only|-or-later)? ; gnu\.org/licenses/lgpl-3
lgpl-2.1 ; lesser ; (?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*2\.1 ; lgpl-2\.1(?:-only|-or-later)? ; gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1
lgpl ; lesser ; (?:gnu\s+)?lesser\s+general\s+public\s+licen[sc]e ; lgpl ; gnu\.org/licenses/lgpl
lgpl-2.0 ; library ; (?:gnu\s+)?library\s+general\s+public\s+licen[sc]e ; lgpl-2\.0(?:-only|-or-later)? ; gnu\.org/licenses/old-licenses/lgpl-2\.0
gpl-3.0 ; general ; (?:gnu\s+)?general\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*3(?:\.0)? ; gpl-3\.0(?:-only|-or-later)? ; gnu\.org/licenses/gpl-3
gpl-2.0 ; general ; (?:gnu\s+)?general\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*2(?:\.0)? ; gpl-2\.0(?:-only|-or-later)? ; gnu\.org/licenses/(?:old-licenses/)?gpl-2
gpl-1.0 ; general ; (?:gnu\s+)?general\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*1(?:\.0)? ; gpl-1\.0(?:-only|-or-later)? ; gnu\.org/licenses/(?:old-licenses/)?gpl-1
gpl ; gnu ; gnu\s+general\s+public\s+licen[sc]e ; gpl ; gnu\.org/licenses/gpl
gfdl ; documentation ; (?:gnu\s+)?free\s+documentation\s+licen[sc]e ; gfdl-1\.[1-3](?:-only|-or-later)? ; gnu\.org/licenses/fdl
mpl-2.0 ; mozilla ; mozilla\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*2(?:\.0)? ; mpl-2\.0 ; mozilla\.org/(?:en-us/)?mpl/2\.0
mpl-1.1 ; mozilla ; mozilla\s+public\s+licen[sc]e,?\s+(?:version|v\.?)\s*1\.1 ; mpl-1\.1 ; mozilla\.org/(?:en-us/)?mpl/1\.1
mpl ; mozilla ; mozilla\s+public\s+licen[sc]e ; mpl ; mozilla\.org/(?:en-us/)?mpl
epl-2.0 ; eclipse ; eclipse\s+public\s+licen[sc]e\s*(?:-|,)?\s*(?:version|v\.?)?\s*2(?:\.0)? ; epl-2\.0 ; eclipse\.org/legal/epl-2\.0
epl-1.0 ; eclipse ; eclipse\s+public\s+licen[sc]e\s*(?:-|,)?\s*(?:version|v\.?)?\s*1(?:\.0)? ; epl-1\.0 ; eclipse\.org/legal/epl-v10
edl-1.0 ; eclipse ; eclipse\s+distribution\s+licen[sc]e ; edl-1\.0 ; eclipse\.org/org/documents/edl
cddl ; development ; common\s+development\s+and\s+distribution\s+licen[sc]e ; cddl-1\.[01] ; opensource\.org/licenses/cddl
cpl-1.0 ; common ; common\s+public\s+licen[sc]e(?!\s+attribution) ; cpl-1\.0 ; opensource\.org/licenses/cpl1\.0
cpal-1.0 ; attribution ; common\s+public\s+attribution\s+licen[sc]e ; cpal-1\.0 ; opensource\.org/licenses/cpal
eupl-1.2 ; european ; european\s+union\s+public\s+licen[sc]e(?:,?\s+(?:version|v\.?)\s*1\.2)? ; eupl-1\.[12] ; joinup\.ec\.europa\.eu/.{0,40}eupl
osl-3.0 ; software ; open\s+software\s+licen[sc]e ; osl-[123]\.[01] ; opensource\.org/licenses/osl
afl-3.0 ; academic ; academic\s+free\s+licen[sc]e ; afl-[123]\.[0-2] ; opensource\.org/licenses/afl
artistic-2.0 ; artistic ; artistic\s+licen[sc]e,?\s+(?:version|v\.?)?\s*2(?:\.0)? ; artistic-2\.0 ; opensource\.org/licenses/artistic-2\.0
artistic-1.0 ; artistic ; artistic\s+licen[sc]e ; artistic-1\.0(?:-perl)? ; opensource\.org/licenses/artistic
isc ; isc ; (?<![a-z])isc\s+licen[sc]e ; isc ; opensource\.org/licenses/isc
zlib ; zlib ; zlib(?:/libpng)?\s+licen[sc]e ; zlib ; opensource\.org/licenses/zlib
libpng ; libpng ; libpng\s+licen[sc]e ; libpng(?:-2\.0)? ; libpng\.org/pub/png/src/libpng-license
bsl-1.0 ; boost ; boost\s+software\s+licen[sc]e ; bsl-1\.0 ; boost\.org/license_1_0
unlicense ; unlicense ; the\s+unlicense ; unlicense ; unlicense\.org
wtfpl ; wtfpl ; wtfpl ; wtfpl ; wtfpl\.net
0bsd ; bsd ; zero[-\s]clause\s+bsd ; 0bsd ; opensource\.org/licenses/0bsd
python-2.0 ; python ; python\s+(?:software\s+foundation\s+)?licen[sc]e ; (?:python|psf)-2\.0 ; docs\.python\.org/.{0,12}license
postgresql ; postgresql ; postgresql\s+licen[sc]e ; postgresql ; postgresql\.org/about/licence
php-3.01 ; php ; (?<![a-z])php\s+licen[sc]e ; php-3\.0[01]? ; php\.net/license
ruby ; ruby ; (?<![a-z])ruby\s+licen[sc]e ; ruby ; ruby-lang\.org/.{0,12}license
openssl ; openssl ; openssl\s+licen[sc]e ; openssl ; openssl\.org/source/license
w3c ; w3c ; w3c\s+software\s+(?:notice\s+and\s+)?licen[sc]e ; w3c(?:-\d+)? ; w3\.org/consortium/legal
ncsa ; illinois ; university\s+of\s+illinois/?(?:ncsa)?\s+open\s+source\s+licen[sc]e ; ncsa ; opensource\.org/licenses/ncsa
ms-pl ; microsoft ; microsoft\s+public\s+licen[sc]e ; ms-pl ; opensource\.org/licenses/ms-pl
ms-rl ; microsoft ; microsoft\s+reciprocal\s+licen[sc]e ; ms-rl ; opensource\.org/licenses/ms-rl
ofl-1.1 ; font ; (?:sil\s+)?open\s+font\s+licen[sc]e ; ofl-1\.[01] ; scripts\.sil\.org/ofl
odbl ; database ; open\s+(?:data\s+commons\s+open\s+)?database\s+licen[sc]e ; odbl-1\.0 ; opendatacommons\.org/licenses/odbl
odc-by ; commons ; open\s+data\s+commons\s+attribution\s+licen[sc]e ; odc-by-1\.0 ; opendatacommons\.org/licenses/by
pddl ; dedication ; public\s+domain\s+dedication\s+and\s+licen[sc]e ; pddl-1\.0 ; opendatacommons\.org/licenses/pddl
cdla-permissive ; community ; community\s+data\s+licen[sc]e\s+agreement\s*[-,]?\s*permissive ; cdla-permissive-[12]\.0 ; cdla\.(?:dev|io)/permissive
cdla-sharing ; community ; community\s+data\s+licen[sc]e\s+agreement\s*[-,]?\s*sharing ; cdla-sharing-1\.0 ; cdla\.(?:dev|io)/sharing
cc0-1.0 ; cc0 ; (?<![a-z])cc0(?:\s+1\.0)? ; cc0-1\.0 ; creativecommons\.org/publicdomain/zero
cc-by-nc-nd ; noncommercial ; attribution-noncommercial-noderiv\w* ; cc-by-nc-nd-[1-4]\.0 ; creativecommons\.org/licenses/by-nc-nd
cc-by-nc-sa ; noncommercial ; attribution-noncommercial-sharealike ; cc-by-nc-sa-[1-4]\.0 ; creativecommons\.org/licenses/by-nc-sa
cc-by-nc ; noncommercial ; attribution-noncommercial ; cc-by-nc-[1-4]\.0 ; creativecommons\.org/licenses/by-nc
cc-by-nd ; noderiv ; attribution-noderiv\w* ; cc-by-nd-[1-4]\.0 ; creativecommons\.org/licenses/by-nd
cc-by-sa ; sharealike ; (?:attribution[-\s]+)?sharealike(?:\s+[1-4]\.0)? ; cc-by-sa-[1-4]\.0 ; creativecommons\.org/licenses/by-sa
cc-by-nc-nd ; cc ; (?<![a-z])cc[-\s]+by[-\s]+nc[-\s]+nd(?![a-z]) ; - ; -
cc-by-nc-sa ; cc ; (?<![a-z])cc[-\s]+by[-\s]+nc[-\s]+sa(?![a-z]) ; - ; -
cc-by-nc ; cc ; (?<![a-z])cc[-\s]+by[-\s]+nc(?![a-z]) ; - ; -
cc-by-nd ; cc ; (?<![a-z])cc[-\s]+by[-\s]+nd(?![a-z]) ; - ; -
cc-by-sa ; cc ; (?<![a-z])cc[-\s]+by[-\s]+sa(?![a-z]) ; - ; -
cc-by ; creative ; creative\s+commons\s+attribution(?:\s+[1-4]\.0)?(?:\s+international)? ; cc-by-[1-4]\.0 ; creativecommons\.org/licenses/by/
cc ; creative ; creative\s+commons(?:\s+licen[sc]e)? ; - ; creativecommons\.org
"""

# Texts that show terms without a name: label, keyword, pattern.
TEXTS = r"""
mit ; permission ; permission\s+is\s+hereby\s+granted,?\s+free\s+of\s+charge,?\s+to\s+any\s+person
isc ; permission ; permission\s+to\s+use,?\s+copy,?\s+modify,?\s+and(?:/or)?\s+distribute\s+this\s+software
bsd ; redistribution ; redistribution\s+and\s+use\s+in\s+source\s+and\s+binary\s+forms
bsd-3-clause ; endorse ; used\s+to\s+endorse\s+or\s+promote\s+products\s+derived
zlib ; misrepresented ; origin\s+of\s+this\s+software\s+must\s+not\s+be\s+misrepresented
gpl ; redistribute ; you\s+can\s+redistribute\s+it\s+and/or\s+modify\s+it\s+under\s+the\s+terms
unlicense ; released ; free\s+and\s+unencumbered\s+software\s+released\s+into\s+the\s+public\s+domain
public-domain ; public ; (?:in|into|to)\s+the\s+public\s+domain
warranty ; warrant ; without\s+warranty\s+of\s+any\s+kind
warranty ; warrant ; without\s+any\s+(?:express(?:ed)?\s+or\s+implied\s+)?warrant(?:y|ies)
warranty ; provided ; provided\s+["'“]?as\s+is["'”]?
copyright ; copyright ; copyright\s+(?:\(c\)|©)\s*(?:1[89]|20)\d\d
copyright ; copyright ; copyright\s+(?:1[89]|20)\d\d
copyright ; © ; ©\s*(?:1[89]|20)\d\d
reserved ; reserved ; (?<![a-z])all\s+rights\s+(?:are\s+)?reserved
reserved ; reserved ; (?<![a-z])some\s+rights\s+reserved
proprietary ; proprietary ; proprietary\s+and\s+confidential
proprietary ; confidential ; confidential\s+(?:and\s+proprietary\s+)?information\s+of
no-redistribution ; copied ; (?:may|must|shall)\s+not\s+be\s+copied
no-redistribution ; reproduced ; (?:may|must|shall)\s+not\s+be\s+reproduced
no-redistribution ; redistributed ; (?:may|must|shall)\s+not\s+be\s+redistributed
no-redistribution ; redistribut ; redistribution\s+(?:is\s+)?(?:strictly\s+)?prohibited
non-commercial ; commercial ; (?:for\s+)?non[-\s]?commercial\s+use\s+only
licensed ; licen ; licen[sc]ed\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?[a-z0-9][a-z0-9.\-]*
licensed ; licen ; see\s+(?:the\s+)?licen[sc]e\s+file
"""

# Tiers: a notice that names the license outright, its name or address, text that suggests terms.
NOTICE, NAME, HINT = 0, 1, 2
CONFIDENCE = (0.95, 0.8, 0.5)


class Rule(NamedTuple):
    label: str
    keyword: str
    pattern: str
    tier: int


def _fields(table: str) -> list[list[str]]:
    return [[part.strip() for part in line.split(" ; ")] for line in table.strip().splitlines()]


def build_rules() -> list[Rule]:
    """All rules, the first of equal ones first: notices, then names and addresses, then hints."""
    notices, names = [], []
    for label, keyword, name, short, address in _fields(LICENSES):
        notices.append(Rule(label, keyword, rf"(?:released|distributed|available|licen[sc]ed|published)\s+under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?(?:{name})", NOTICE))
        if short != "-":
            notices.append(Rule(label, "spdx", rf"spdx-license-identifier:\s*{short}(?![\w.-])", NOTICE))
        names.append(Rule(label, keyword, name, NAME))
        if address != "-":
            names.append(Rule(label, "://", rf"https?://(?:www\.)?{address}[\w./-]*", NAME))
    return notices + names + [Rule(label, keyword, pattern, HINT) for label, keyword, pattern in _fields(TEXTS)]
