import random
import re

from dockflow.llm import licenses
from tests.llm.frames import documents, empty, lower


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    hits = [
        (i, label)
        for phrase, label in licenses.BASE
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    places = [i for i, _ in hits]
    return (len(words), len(hits), min(places, default=None), max(places, default=None), ",".join(sorted({n for _, n in hits})))


def test_base_counts_agree_with_the_plain_definition(spark):
    docs = documents(spark)
    rows = licenses.license_scan(docs).collect()
    fields = ("n_words", "n_base", "first_word", "last_word", "base_labels")
    expected = [(r["doc_id"], *plain(r["text"])) for r in docs.collect()]
    key = str
    assert sorted(((r["doc_id"], *(r[f] for f in fields)) for r in rows), key=key) == sorted(expected, key=key)
    for r in rows:
        assert 0 <= r["score"] <= 1
        assert set(filter(None, r["base_labels"].split(","))) <= set(filter(None, r["labels"].split(",")))


def labels(text):
    return licenses.scan(text.encode()).labels


def test_rules_and_suppression():
    assert len(licenses.rules()) > 350
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]
    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by", "cc-by-nc"]
    assert labels("SPDX-License-Identifier: MIT") == ["mit"]
    assert labels("This work is licensed under the GNU General Public License, version 3.") == ["gpl", "gpl-3.0"]
    assert labels("released under the terms of the BSD 3-Clause license") == ["bsd-3-clause"]
    assert labels("a cc byte mitten apache helicopter") == []
    long = (0, 9, 40, "whole")
    assert licenses.suppressed([(2, 5, 20, "part"), long, (2, 12, 20, "over the edge"), (0, 9, 40, "whole")]) == [long, (2, 12, 20, "over the edge")]
    far = [(i * 3, i * 3 + 3, 10, "x") for i in range(500)]
    assert licenses.suppressed([*far, (0, 1500, 50, "all")]) == [(0, 1500, 50, "all")]


def test_keywords_gate_no_rule_out():
    finder, _ = licenses._prefilter()
    for rule in licenses.rules():
        name = rule.pattern.pattern.decode()
        assert rule.keyword in re.sub(r"[^a-z0-9]+", " ", name).split(), name


def test_empty_table(spark):
    assert licenses.license_scan(empty(spark)).count() == 0


def sample(rng, parsed):
    """A random string that the parsed expression accepts."""
    made = ""
    for kind, value in parsed:
        name = str(kind)
        if name == "LITERAL":
            made += chr(value)
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            made += "".join(sample(rng, value[2]) for _ in range(rng.randint(value[0], min(value[1], 4))))
        elif name == "SUBPATTERN":
            made += sample(rng, value[3])
        elif name == "BRANCH":
            made += sample(rng, rng.choice(value[1]))
        elif name == "NOT_LITERAL":
            made += "q"
        elif name == "IN":
            low = value[0][1]
            made += chr(low[0] if isinstance(low, tuple) else low)
        else:
            assert name in ("ASSERT", "ASSERT_NOT"), name
    return made


def test_each_rule_detects_as_much_behind_the_prefilter():
    rng = random.Random(1)
    for rule in licenses.rules():
        for _ in range(40):
            text = f" {sample(rng, re._parser.parse(rule.pattern.pattern.decode()))} "
            assert rule.pattern.search(text.encode()), text
            finder, _ = licenses._prefilter()
            assert rule.keyword in {word for _, word in finder.iter(text)}, (rule.label, text)


def test_joined_versions():
    assert labels("Licensed under GPLv3") == ["gpl-3.0-short"]
    assert labels("Licensed under GPL2.") == ["gpl-2.0-short"]
    assert labels("Licensed under LGPLv2.1") == ["lgpl"]
    assert labels("Licensed under AGPLv3") == ["agpl"]
    assert labels("Licensed under MPLv2.0") == ["mpl"]
    assert labels("Licensed under Apache2") == ["apache-2.0"]
    assert labels("noncommercial use only") == ["non-commercial"]


# Titles, headers, tags and bodies as they stand in files, each with the label that it must get.
REAL = """
Apache License, Version 2.0 => apache-2.0
Apache License 2.0 => apache-2.0
The Apache Software License, Version 1.1 => apache-1.1
Apache License\tVersion 2.0, January 2004 => apache-2.0
http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION => apache-2.0
you may not use this file except in compliance with the License. => apache-2.0
See the License for the specific language governing permissions and limitations under the License. => apache-2.0
Licensed under the Apache License, Version 2.0 (the "License") => apache-2.0
Mozilla Public License Version 2.0 => mpl-2.0
Mozilla Public License, v. 2.0 => mpl-2.0
This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. => mpl-2.0
The contents of this file are subject to the Mozilla Public License Version 1.1 => mpl-1.1
MPL 2.0 => mpl-2.0
Eclipse Public License - v 2.0 => epl-2.0
Eclipse Public License - v 1.0 => epl-1.0
This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 => epl-2.0
Eclipse Distribution License - v 1.0 => edl-1.0
Creative Commons Attribution 4.0 International => cc-attribution
Creative Commons Attribution-ShareAlike 4.0 International Public License => cc-by-sa
Creative Commons Attribution-NonCommercial 4.0 International => cc-by-nc
Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International => cc-by-nc-nd
Creative Commons Attribution-NonCommercial-NoDerivs 3.0 Unported => cc-by-nc-nd
Creative Commons Attribution-NonCommercial-ShareAlike 3.0 => cc-by-nc-sa
Creative Commons Attribution-NoDerivatives 4.0 International => cc-by-nd
CC BY-NC-ND 4.0 => cc-by-nc-nd
CC BY-NC-SA 4.0 => cc-by-nc-sa
CC-BY-NC-4.0 => cc-by-nc
CC BY-SA 3.0 => cc-by-sa
CC BY-ND 4.0 => cc-by-nd
CC BY 4.0 => cc-by
CC0 1.0 Universal => cc0-1.0
has waived all copyright and related or neighboring rights to this work => cc0-1.0
The MIT License (MIT) => mit
Released under the MIT license. => mit
License: MIT => mit
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software") => mit
MIT No Attribution => mit-0
ISC License => isc
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice => isc
Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. => 0bsd
BSD Zero Clause License => 0bsd
BSD 2-Clause License => bsd-2-clause
BSD 3-Clause License => bsd-3-clause
3-Clause BSD License => bsd-3-clause
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met => bsd
Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived => bsd-3-clause
All advertising materials mentioning features or use of this software must display the following acknowledgement => bsd-4-clause
GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 => gpl-3.0
GNU GENERAL PUBLIC LICENSE Version 2, June 1991 => gpl-2.0
GNU General Public License v2.0 => gpl-2.0
GPLv3 => gpl-3.0
GPL-2.0 => gpl-2.0
redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License => gpl-3.0
redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License => gpl-2.0
redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License => lgpl-2.1
redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 => agpl-3.0
GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 => lgpl-2.1
GNU Lesser General Public License v3 => lgpl-3.0
GNU Library General Public License, version 2 => lgpl-2.0
LGPLv3 => lgpl-3.0
LGPL-2.1 => lgpl-2.1
GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 => agpl-3.0
AGPLv3 => agpl-3.0
GNU Free Documentation License Version 1.3, 3 November 2008 => fdl
Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License => fdl
Boost Software License - Version 1.0 - August 17th, 2003 => boost-1.0
The Unlicense => unlicense
This is free and unencumbered software released into the public domain. => unlicense
zlib License => zlib
In no event will the authors be held liable for any damages arising from the use of this software. => zlib
DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE => wtfpl
As long as you retain this notice you can do whatever you want with this stuff. => beerware
COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0 => cddl-1.0
COMMON DEVELOPMENT AND DISTRIBUTION LICENSE Version 1.1 => cddl-1.1
Common Public License Version 1.0 => cpl-1.0
European Union Public Licence v. 1.2 => eupl-1.2
EUROPEAN UNION PUBLIC LICENCE EUPL v1.1 => eupl-1.1
The Artistic License 2.0 => artistic-2.0
PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2 => python
The PHP License, version 3.01 => php-3.0
PostgreSQL Licence => postgresql
Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted => postgresql
University of Illinois/NCSA Open Source License => ncsa
Microsoft Public License (Ms-PL) => ms-pl
Academic Free License ("AFL") v. 3.0 => afl-3.0
Open Software License v. 3.0 => osl-3.0
SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007 => ofl-1.1
This Font Software is licensed under the SIL Open Font License, Version 1.1. => ofl-1.1
Open Database License (ODbL) v1.0 => odbl-1.0
Open Data Commons Attribution License v1.0 => odc-by-1.0
Elastic License 2.0 => elastic-2.0
You may not provide the software to third parties as a hosted or managed service => elastic-2.0
Server Side Public License VERSION 1 => sspl-1.0
Business Source License 1.1 => bsl-1.1
Llama 3 Community License Agreement => llama-community
This product includes software developed by the OpenSSL Project => openssl
SPDX-License-Identifier: GPL-2.0-or-later => gpl-2.0
SPDX-License-Identifier: LGPL-2.1-only => lgpl-2.1
SPDX-License-Identifier: MIT OR Apache-2.0 => apache-2.0
SPDX-License-Identifier: Apache-2.0 OR MIT => mit
"""

CLEAN = """
The apache helicopter landed at two. She has the license to drive. We run Apache 2.4 behind a proxy.
The boost in sales was common in open markets. Ruby and Python are languages; curl is a tool.
He took a creative approach to the general question. The public library opens at nine.
Eclipse of the moon, version 2. The elastic band broke twice. A llama walked down the road.
Mit dem Zug nach Berlin. The mozilla browser is open. An artistic gymnast won the gold.
Business travel is up. The server side of the church. Microsoft shipped an update in March.
The driver lost a fishing license. Perl necklaces are misspelled. Postgresql and MySQL store rows.
European union leaders met. Academic freedom matters. The documentation was free of errors.
Zero clauses remain in the contract. The isc conference begins. Beer was served to the guests.
The database was open. Sil is a river. The font was bold. Compliance with the rules is expected.
Neither the name of the river nor the names of its banks are known. In no event will rain stop play.
Permission to enter was granted. The advertising was loud. The terms were fair. Either you or mit.
The cat slept. The dog barked at noon. Rain fell. He signed the contract today. Prices rose again.
The software is slow. Copying was easy. The source was a spring. Free tickets were granted. Water is common.
The public was informed. Foundation work began. Universal joints broke. The attribution was wrong. He left.
"""


def test_real_titles_headers_tags_and_bodies():
    cases = [line.rsplit(" => ", 1) for line in REAL.strip().splitlines()]
    cases += [(f"// SPDX-License-Identifier: {name}", name.lower()) for name in licenses.IDENTIFIERS]
    assert len(cases) >= 150
    wrong = [(text, label, labels(text)) for text, label in cases if label not in labels(text)]
    assert not wrong, wrong
    for text, label in cases[-len(licenses.IDENTIFIERS) :]:
        assert set(labels(text)) <= {label, "cc-by"}, text


def test_clean_sentences_have_no_label():
    sentences = [s for s in re.split(r"(?<=[.])\s+", CLEAN.strip()) if s]
    assert len(sentences) >= 40
    assert not [(s, labels(s)) for s in sentences if labels(s)]
    assert labels(CLEAN) == []
