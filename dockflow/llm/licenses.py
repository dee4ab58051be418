"""License scan by ordered signature rules.

A text becomes its words in lower case with one blank between them. An automaton finds the rules' keywords in one pass, as
words or, where a version may be joined to them, as a word's beginning; only rules whose keyword occurs are tried. A detection is an interval of words with the rule's priority; it is dropped
if an interval of higher priority (or, at equal priority, a longer or earlier one) contains it.
"""

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases that always count, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Licenses: label, keyword that a text must hold, and the name as a regular expression over words.
FAMILIES = (
    ("apache-1.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 0"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?1 1"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: license)?(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)? license"),
    ("mit", "mit", r"mit"),
    ("mit-0", "mit", r"mit (?:0|no attribution)"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd)"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("isc", "isc", r"isc"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("libpng", "libpng", r"libpng"),
    ("boost-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?"),
    ("gpl-1.0", "gnu", r"gnu general public license(?: version| v)? ?1(?: 0)?"),
    ("gpl-2.0", "gnu", r"gnu general public license(?: version| v)? ?2(?: 0)?"),
    ("gpl-3.0", "gnu", r"gnu general public license(?: version| v)? ?3(?: 0)?"),
    ("gpl-2.0-short", "gpl", r"gpl ?(?:version |v)? ?2(?: 0)?"),
    ("gpl-3.0-short", "gpl", r"gpl ?(?:version |v)? ?3(?: 0)?"),
    ("lgpl-2.0", "gnu", r"gnu (?:lesser|library) general public license(?: version| v)? ?2(?: 0)?"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license(?: version| v)? ?2 1"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public license(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "lgpl", r"lgpl ?(?:version |v)? ?(?:[23](?: [01])?)?"),
    ("agpl-1.0", "affero", r"affero general public license(?: version| v)? ?1(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?: version| v)? ?3(?: 0)?"),
    ("agpl", "agpl", r"agpl ?(?:version |v)? ?(?:[13](?: 0)?)?"),
    ("fdl", "documentation", r"gnu free documentation license(?: version| v)?(?: 1 [1-3])?"),
    ("mpl-1.0", "mozilla", r"mozilla public license(?: version| v)? ?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mpl", r"mpl ?(?:version |v)? ?[12] [01]"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? ?2(?: 0)?"),
    ("edl-1.0", "eclipse", r"eclipse distribution license(?: version| v)?(?: 1 0)?"),
    ("cddl-1.0", "cddl", r"(?:common development and distribution license )?cddl(?: version| v)?(?: 1 0)?"),
    ("cddl-1.1", "cddl", r"(?:common development and distribution license )?cddl(?: version| v)? 1 1"),
    ("cpl-1.0", "common", r"common public license(?: version| v)?(?: 1 0)?"),
    ("cpal-1.0", "common", r"common public attribution license(?: version| v)?(?: 1 0)?"),
    ("eupl-1.1", "eupl", r"(?:european union public licen[cs]e )?eupl(?: version| v)? ?1 1"),
    ("eupl-1.2", "eupl", r"(?:european union public licen[cs]e )?eupl(?: version| v)? ?1 2"),
    ("artistic-1.0", "artistic", r"artistic license(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license(?: version| v)? ?2(?: 0)?"),
    ("python", "python", r"python software foundation license(?: version)?(?: 2)?"),
    ("php-3.0", "php", r"php license(?: version| v)? ?3(?: 0(?: 1)?)?"),
    ("ruby", "ruby", r"ruby"),
    ("perl", "perl", r"(?:the same terms as )?perl(?: itself)?"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("curl", "curl", r"curl"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "public", r"do what the fuck you want to public license"),
    ("beerware", "beerware", r"beerware"),
    ("x11", "x11", r"x11"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)?"),
    ("ms-pl", "microsoft", r"microsoft public license"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license"),
    ("afl-3.0", "academic", r"academic free license(?: version| v)?(?: 3 0)?"),
    ("osl-3.0", "open", r"open software license(?: version| v)?(?: 3 0)?"),
    ("ofl-1.1", "sil", r"sil open font license(?: version| v)?(?: 1 [01])?"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: version| v)?(?: 1 0)?"),
    ("odc-by-1.0", "commons", r"open data commons attribution license(?: version| v)?(?: 1 0)?"),
    ("pddl-1.0", "dedication", r"public domain dedication and license(?: version| v)?(?: 1 0)?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc-zero", "creative", r"creative commons zero(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-plain", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-attribution-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?"),
    ("cc-attribution-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: [1-4] [05])?"),
    ("cc-attribution-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?"),
    ("cc-attribution", "creative", r"creative commons attribution(?: [1-4] [05])?"),
    ("public-domain", "domain", r"public domain"),
    ("elastic-2.0", "elastic", r"elastic license(?: version| v)?(?: 2 0)?"),
    ("sspl-1.0", "server", r"server side public license(?: version| v)?(?: 1)?"),
    ("bsl-1.1", "business", r"business source license(?: version| v)?(?: 1 1)?"),
    ("openrail", "rail", r"(?:bigscience |creativeml )?(?:open )?rail(?: m)?"),
    ("llama-community", "llama", r"llama(?: [234])?(?: [0-9])? community license(?: agreement)?"),
)

# What may stand around a license's name: kind, priority, and a template for the words.
TEMPLATES = (
    ("tag", 48, r"spdx license identifier {name}(?: license)?"),
    ("notice", 40, r"(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: licen[cs]e)?"),
    ("subject", 35, r"(?:subject to|governed by|covered by|in accordance with) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: licen[cs]e)?"),
    ("field", 30, r"licen[cs]e {name}(?: licen[cs]e)?"),
    ("name", 20, r"{name} (?:public )?licen[cs]e"),
)

# Names that are common words: a sentence that begins with one may stand behind "license", so no field rule for them.
PLAIN = ("ruby", "perl", "curl")

# Notices that name no license: label, keyword, priority, words.
NOTICES = (
    ("reserved", "reserved", 25, r"(?:copyright (?:c )?(?:[0-9]{4} )?(?:by )?(?:[^ ]+ ){0,6}?)?all rights reserved"),
    ("reserved", "reserved", 25, r"some rights reserved"),
    ("reserved", "reserved", 25, r"no rights reserved"),
    ("copyright", "copyright", 10, r"copyright (?:c )?(?:[0-9]{4} )(?:[0-9]{4} )?(?:by )?[^ ]+"),
    ("copyright", "copyrighted", 10, r"copyrighted (?:material|work|content)"),
    ("permission", "permission", 28, r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("permission", "permission", 28, r"permission to use copy modify and or distribute this software"),
    ("permission", "redistribution", 28, r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("permission", "reproduced", 22, r"may (?:not )?be reproduced (?:[^ ]+ ){0,8}?without (?:the )?(?:prior )?(?:written )?permission"),
    ("warranty", "warranty", 15, r"without warranty of any kind"),
    ("warranty", "warranties", 15, r"without warranties or conditions of any kind"),
    ("warranty", "merchantability", 15, r"merchantability or fitness for a particular purpose"),
    ("proprietary", "proprietary", 26, r"(?:confidential and proprietary|proprietary and confidential)"),
    ("terms-of-use", "terms", 12, r"terms of (?:use|service)(?: apply)?"),
    ("non-commercial", "commercial", 24, r"(?:for )?non ?commercial use only"),
    ("no-derivatives", "derivative", 24, r"no derivative works"),
    ("open-access", "access", 14, r"this is an open access (?:article|work)"),
    ("dual", "dual", 27, r"dual licensed under"),
    ("gpl", "general", 18, r"(?:gnu )?(?:lesser |affero |library )?general public license"),
    ("cc-by", "cc", 18, r"cc by"),
)


# Titles that name a license by themselves: label, keyword, words. {v} is what may stand before a version.
TITLES = (
    ("apache-1.0", "apache", r"apache(?: software)? license{v}1 0"),
    ("apache-1.1", "apache", r"apache(?: software)? license{v}1 1"),
    ("apache-2.0", "apache", r"apache(?: software)? license{v}2(?: 0)?"),
    ("mit", "mit", r"the mit license(?: mit)?"),
    ("mit-0", "attribution", r"mit no attribution"),
    ("0bsd", "bsd", r"(?:zero clause bsd|bsd zero clause)"),
    ("0bsd", "0bsd", r"0bsd"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|2 clause bsd|simplified bsd)"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|modified bsd|revised bsd)"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd)"),
    ("isc", "isc", r"isc license(?: isc)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? license"),
    ("boost-1.0", "boost", r"boost software license(?:{v}1 0)?"),
    ("gpl-1.0", "general", r"(?:gnu )?general public license{v}1(?: 0)?"),
    ("gpl-2.0", "general", r"(?:gnu )?general public license{v}2(?: 0)?"),
    ("gpl-3.0", "general", r"(?:gnu )?general public license{v}3(?: 0)?"),
    ("gpl-1.0", "gpl", r"gpl ?(?:version )?v? ?1(?: 0)?"),
    ("gpl-2.0", "gpl", r"gpl ?(?:version )?v? ?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"gpl ?(?:version )?v? ?3(?: 0)?"),
    ("lgpl-2.0", "library", r"gnu library general public license(?:{v}2(?: 0)?)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license{v}2 1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license{v}3(?: 0)?"),
    ("lgpl-2.1", "lgpl", r"lgpl ?(?:version )?v? ?2 1"),
    ("lgpl-3.0", "lgpl", r"lgpl ?(?:version )?v? ?3(?: 0)?"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license(?:{v}3(?: 0)?)?"),
    ("agpl-3.0", "agpl", r"agpl ?(?:version )?v? ?3(?: 0)?"),
    ("fdl", "documentation", r"gnu free documentation license(?:{v}1 [1-3])?"),
    ("mpl-1.0", "mozilla", r"mozilla public license{v}1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license{v}1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public license{v}2(?: 0)?"),
    ("mpl-2.0", "mpl", r"mpl ?v? ?2 0"),
    ("epl-1.0", "eclipse", r"eclipse public license{v}1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license{v}2(?: 0)?"),
    ("edl-1.0", "eclipse", r"eclipse distribution license(?:{v}1 0)?"),
    ("cddl-1.0", "common", r"common development and distribution license(?: cddl)?(?:{v}1 0)?"),
    ("cddl-1.1", "common", r"common development and distribution license(?: cddl)?{v}1 1"),
    ("cpl-1.0", "common", r"common public license(?:{v}1 0)?"),
    ("cpal-1.0", "common", r"common public attribution license(?:{v}1 0)?"),
    ("eupl-1.1", "european", r"european union public licen[cs]e(?: eupl)?{v}1 1"),
    ("eupl-1.2", "european", r"european union public licen[cs]e(?: eupl)?{v}1 2"),
    ("artistic-1.0", "artistic", r"artistic license{v}1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic license{v}2(?: 0)?"),
    ("python", "python", r"python software foundation license(?:{v}2)?"),
    ("php-3.0", "php", r"php license{v}3(?: 0(?: 1)?)?"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("unlicense", "unlicense", r"the unlicense"),
    ("wtfpl", "public", r"do what the fuck you want to public license"),
    ("beerware", "beer", r"beer ware license"),
    ("ncsa", "ncsa", r"university of illinois ncsa open source license"),
    ("ms-pl", "microsoft", r"microsoft public license(?: ms pl)?"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license(?: ms rl)?"),
    ("afl-3.0", "academic", r"academic free license(?:{v}3 0)?"),
    ("osl-3.0", "open", r"open software license{v}3 0"),
    ("ofl-1.1", "sil", r"sil open font license(?:{v}1 [01])?"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: odbl)?(?:{v}1 0)?"),
    ("odc-by-1.0", "commons", r"open data commons attribution license(?:{v}1 0)?"),
    ("pddl-1.0", "dedication", r"public domain dedication and license(?:{v}1 0)?"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "creative", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nc-sa", "creative", r"creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("cc-attribution", "creative", r"creative commons attribution(?: licen[cs]e)?(?: [1-4] [05])?(?: (?:international|unported|generic))?"),
    ("elastic-2.0", "elastic", r"elastic license{v}2(?: 0)?"),
    ("sspl-1.0", "server", r"server side public license(?:{v}1)?"),
    ("bsl-1.1", "business", r"business source license(?:{v}1 1)?"),
    ("llama-community", "llama", r"llama(?: [234])?(?: [0-9])? community license(?: agreement)?"),
    ("cecill-2.1", "cecill", r"cecill free software license agreement(?:{v}2 1)?"),
    ("wtfpl", "wtfpl", r"wtfpl(?:{v}2)?"),
    ("mulan-2.0", "mulan", r"mulan permissive software license{v}2"),
)
VERSION = r"(?: version)? (?:v ?)?"

# Sentences of headers and bodies: label, keyword, words.
GNU = r"as published by the free software foundation (?:either )?version"
BODIES = (
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", "governing", r"see the license for the specific language governing permissions and limitations under the license"),
    ("apache-2.0", "reproduction", r"terms and conditions for use reproduction and distribution"),
    ("apache-1.1", "apache", r"this product includes software developed by the apache software foundation"),
    ("mit", "granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("boost-1.0", "granted", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "granted", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "granted", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "granted", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "endorse", r"neither the names? of (?:[^ ]+ ){1,12}?nor the names of (?:its|the|their|any) contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("gpl-2.0", "gnu", r"under the terms of the gnu general public license " + GNU + " 2"),
    ("gpl-3.0", "gnu", r"under the terms of the gnu general public license " + GNU + " 3"),
    ("lgpl-2.0", "gnu", r"under the terms of the gnu library general public license " + GNU + " 2"),
    ("lgpl-2.1", "gnu", r"under the terms of the gnu lesser general public license " + GNU + " 2 1"),
    ("lgpl-3.0", "gnu", r"under the terms of the gnu lesser general public license " + GNU + " 3"),
    ("agpl-3.0", "gnu", r"under the terms of the gnu affero general public license " + GNU + " 3"),
    ("fdl", "gnu", r"distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2.0", "mozilla", r"this source code form is subject to the terms of the mozilla public license v ?2 0"),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "eclipse", r"made available under the terms of the eclipse public license v ?1 0"),
    ("epl-2.0", "eclipse", r"made available under the terms of the eclipse public license (?:v ?)?2 0"),
    ("zlib", "liable", r"in no event will the authors be held liable for any damages arising from the use of this software"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", "just", r"you just do what the fuck you want to"),
    ("beerware", "retain", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("ofl-1.1", "sil", r"this font software is licensed under the sil open font license version 1 1"),
    ("cc0-1.0", "waived", r"waived all copyright and related or neighbou?ring rights"),
    ("openssl", "openssl", r"this product includes software developed by the openssl project"),
    ("php-3.0", "php", r"this product includes php software freely available from"),
    ("python", "python", r"this license agreement is between the python software foundation"),
    ("artistic-1.0", "intent", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("elastic-2.0", "hosted", r"you may not provide the software to third parties as a hosted or managed service"),
    ("bsl-1.1", "licensor", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("perl", "perl", r"under the same terms as perl itself"),
    ("cddl-1.0", "common", r"subject to the terms of the common development and distribution license"),
)

# Short identifiers of a license tag; their words are the pattern, the identifier in lower case is the label.
IDENTIFIERS = """
0BSD AFL-3.0 AGPL-1.0 AGPL-3.0 Apache-1.0 Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-1-Clause BSD-2-Clause
BSD-3-Clause BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0
CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 CPAL-1.0 CPL-1.0 curl ECL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0
EUPL-1.1 EUPL-1.2 GFDL-1.1 GFDL-1.2 GFDL-1.3 GPL-1.0 GPL-2.0 GPL-3.0 ISC LGPL-2.0 LGPL-2.1 LGPL-3.0 Libpng LPPL-1.3c MIT MIT-0
MPL-1.0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 PHP-3.01 PostgreSQL PSF-2.0
Python-2.0 Ruby SSPL-1.0 Unlicense UPL-1.0 Vim WTFPL X11 Zlib ZPL-2.1
""".split()
TAG = "spdx license identifier"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    priority: int
    pattern: re.Pattern


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """Every rule, highest priority first; rules of one priority keep the order written above."""
    made = [Rule(label, word, rank, re.compile(rf"(?<= ){p}(?= )".encode())) for label, word, rank, p in NOTICES]
    for label, word, name in FAMILIES:
        for kind, rank, template in TEMPLATES:
            if kind == "field" and label in PLAIN:
                continue
            pattern = rf"(?<= ){template.format(name=name)}(?= )".encode()
            made.append(Rule(label, word, rank, re.compile(pattern)))
    for label, word, p in TITLES:
        made.append(Rule(label, word, 20, re.compile(rf"(?<= ){p.replace('{v}', VERSION)}(?= )".encode())))
    for label, word, p in BODIES:
        made.append(Rule(label, word, 45, re.compile(rf"(?<= ){p}(?= )".encode())))
    for name in IDENTIFIERS:
        label = name.lower()
        words = " ".join(re.findall("[a-z0-9]+", label))
        ending = "(?: only| or later)?(?= )"
        # The identifier behind the tag, and one that stands behind "or" in its expression: its words are the detection.
        for pattern in (f"(?<= ){TAG} {words}{ending}", f"(?<= ){TAG} (?:[^ ]+ ){{1,8}}?or ({words}){ending}"):
            made.append(Rule(label, "spdx", 50, re.compile(pattern.encode())))
    return tuple(sorted(made, key=lambda rule: -rule.priority))


JOINED = ("apache", "gpl", "lgpl", "agpl", "mpl", "eupl")  # a version may follow these without a blank, as in GPLv3
COMPOUNDS = (("noncommercial", "commercial"),)  # words that rules take for a keyword behind another word


@lru_cache(maxsize=1)
def _prefilter() -> tuple[ahocorasick.Automaton, dict[str, list[int]]]:
    by_word: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        by_word.setdefault(rule.keyword, []).append(i)
    finder = ahocorasick.Automaton()
    for word in [*by_word, *(phrase for phrase, _ in BASE)]:
        finder.add_word(f" {word}" if word in JOINED else f" {word} ", word)
    for compound, word in COMPOUNDS:
        finder.add_word(f" {compound} ", word)
    finder.make_automaton()
    return finder, by_word


def _separators() -> bytes:
    """A byte table: A-Z in lower case, digits and letters and all bytes above ASCII as they are, the rest blank."""
    table = bytearray(range(256))
    for code in range(128):
        c = chr(code)
        table[code] = ord(c.lower()) if c.isalnum() else 0x20
    return bytes(table)


TABLE = _separators()
BLOCK = 64  # words; a text of many detections compares only neighbours


def suppressed(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Detections (start, end, priority, label) that no kept detection contains; the strongest are kept first."""
    kept: list[tuple[int, int, int, str]] = []
    by_block: dict[int, list[tuple[int, int]]] = {}  # kept intervals by the blocks of words they touch
    for one in sorted(found, key=lambda d: (-d[2], d[0] - d[1], d[0], d[3])):
        near = by_block.get(one[0] // BLOCK, ())
        if any(start <= one[0] and one[1] <= end for start, end in near):
            continue
        kept.append(one)
        for block in range(one[0] // BLOCK, (one[1] - 1) // BLOCK + 1):
            by_block.setdefault(block, []).append((one[0], one[1]))
    return sorted(kept)


@dataclass
class Scan:
    n_words: int
    n_base: int = 0
    first_word: int | None = None
    last_word: int | None = None
    base: tuple = ()
    detections: tuple = ()  # (first word, end word, priority, label)

    @property
    def labels(self) -> list[str]:
        return sorted({*self.base, *(d[3] for d in self.detections)})

    @property
    def score(self) -> float:
        """The strongest sign: priorities scaled to 1, and half where only a base phrase was found."""
        best = max((d[2] for d in self.detections), default=0) / rules()[0].priority
        return max(best, 0.5 if self.base else 0.0)


def scan(text: bytes | None) -> Scan:
    words = (text or b"").translate(TABLE).split()
    result = Scan(len(words))
    joined = b" " + b" ".join(words) + b" "
    finder, by_word = _prefilter()
    ascii_text = joined.decode("latin-1")  # one character a byte, so that places agree
    present = {word for _, word in finder.iter(ascii_text)}
    if not present:
        return result
    blanks: list[int] = []

    def word_at(offset: int) -> int:
        if not blanks:
            at = 0
            for word in words:
                blanks.append(at + 1)
                at += len(word) + 1
        return bisect_right(blanks, offset) - 1

    base = []
    for phrase, label in BASE:
        if phrase in present:
            key, at = f" {phrase} ", ascii_text.find(f" {phrase} ")
            while at >= 0:
                result.n_base += 1
                base.append(label)
                at = word_at(at + 1)
                result.first_word = at if result.first_word is None else min(result.first_word, at)
                result.last_word = at if result.last_word is None else max(result.last_word, at)
                at = ascii_text.find(key, blanks[at])
    result.base = tuple(sorted(set(base)))
    found = []
    for i in sorted({i for word in present for i in by_word.get(word, ())}):
        rule = rules()[i]
        for m in rule.pattern.finditer(joined):
            start, end = m.span(m.lastindex or 0)
            found.append((word_at(start), word_at(end - 1) + 1, rule.priority, rule.label))
    result.detections = tuple(suppressed(found))
    return result


OUTPUT = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
    "labels string, score double, detections string"
)


def license_scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of the base phrases, labels, score, and all detections.

    detections lists label:first word:end word by place. A null text is empty; texts without words or signs have
    zero counts, null places, empty lists and score 0. Repeated rows keep a row each, a null doc_id stays null, an empty
    table gives no rows, other columns are not read. A very long text is one row of one task, read once by the
    automaton and once by each rule whose keyword it holds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scans = [scan(text) for text in batch.column("text").cast(pa.binary()).to_pylist()]
            longs = (
                pa.array([getattr(s, c) for s in scans], pa.int64())
                for c in ("n_words", "n_base", "first_word", "last_word")
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *longs,
                    pa.array([",".join(s.base) for s in scans], pa.string()),
                    pa.array([",".join(s.labels) for s in scans], pa.string()),
                    pa.array([s.score for s in scans], pa.float64()),
                    pa.array([",".join(f"{d[3]}:{d[0]}:{d[1]}" for d in s.detections) for s in scans], pa.string()),
                ],
                [c.split()[0] for c in OUTPUT.split(", ")],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, OUTPUT)
