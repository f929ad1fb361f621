"""Operator 4: licence scan by ordered signature rules.

Rules: every licence of ``LICENSES`` (names, identifiers, address fragments) and every Creative
Commons licence (parts and versions) is combined with every phrasing of ``PHRASINGS``, which
generates several hundred rules, each a regular expression with a priority, a confidence and a
keyword. So are the names of families without a version (``FAMILIES``). Characteristic sentences of
licence bodies and standard notices (``BODIES``, ``NOTICES``) are written rules, each as it stands. A keyword automaton runs over the lower-cased
text first, and only rules whose keyword and one of whose phrasing's words (``FRAME_WORDS``) occur are tried. In a
licence expression ("MIT OR Apache-2.0") every operand is a detection of its own. Detections are then resolved in
order of priority, length and place: one that lies inside an accepted one is dropped
(interval containment), and so is one of lower priority that overlaps an accepted one.

Base places: a phrase of ``BASE`` counts wherever its words stand one after another, words
being runs of ASCII letters and digits and of all characters outside ASCII, after A-Z became
lower case. Base labels always stay; the rules add labels of their own.

Score: 1 - product of (1 - confidence) over the accepted detections and the base places outside
them, which count ``BASE_CONFIDENCE`` each; a detection that holds base places counts once, at least
with that. 0 without any.

Defined results: a null text counts as empty (no words, no labels, score 0); rows are judged
one by one, so repeated rows repeat; the whole text is scanned however long it is.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ortholake.llm.common import by_batch, table, text_or_empty

# Phrases of the base scan and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_CONFIDENCE = 0.9

# Label -> (names as regular expressions, identifiers, address fragments).
LICENSES: dict[str, tuple[list[str], list[str], list[str]]] = {
    "gpl-1.0": (["gnu general public license,? (?:version |v)?1(?:\\.0)?"], ["gpl-1.0", "gpl-1.0-only", "gpl-1.0-or-later"], ["gnu.org/licenses/gpl-1.0"]),
    "gpl-2.0": (["gnu general public license,? (?:version |v)?2(?:\\.0)?", "gplv2"], ["gpl-2.0", "gpl-2.0-only", "gpl-2.0-or-later"], ["gnu.org/licenses/gpl-2.0"]),
    "gpl-3.0": (["gnu general public license,? (?:version |v)?3(?:\\.0)?", "gplv3"], ["gpl-3.0", "gpl-3.0-only", "gpl-3.0-or-later"], ["gnu.org/licenses/gpl-3.0"]),
    "lgpl-2.1": (["gnu lesser general public license,? (?:version |v)?2\\.1", "lgplv2"], ["lgpl-2.1", "lgpl-2.1-only", "lgpl-2.1-or-later"], ["gnu.org/licenses/lgpl-2.1"]),
    "lgpl-3.0": (["gnu lesser general public license,? (?:version |v)?3(?:\\.0)?", "lgplv3"], ["lgpl-3.0", "lgpl-3.0-only", "lgpl-3.0-or-later"], ["gnu.org/licenses/lgpl-3.0"]),
    "agpl-3.0": (["gnu affero general public license,? (?:version |v)?3(?:\\.0)?", "agplv3"], ["agpl-3.0", "agpl-3.0-only", "agpl-3.0-or-later"], ["gnu.org/licenses/agpl-3.0"]),
    "fdl-1.3": (["gnu free documentation license,? (?:version |v)?1\\.3"], ["gfdl-1.3", "gfdl-1.3-only", "gfdl-1.3-or-later"], ["gnu.org/licenses/fdl-1.3"]),
    "apache-1.1": (["apache(?: software)? license,? (?:version |v)?1\\.1"], ["apache-1.1"], ["apache.org/licenses/license-1.1"]),
    "apache-2.0": (["apache(?: software)? license,? (?:version |v)?2(?:\\.0)?", "apache 2\\.0 license"], ["apache-2.0"], ["apache.org/licenses/license-2.0"]),
    "mit": (["mit license", "expat license"], ["mit"], ["opensource.org/licenses/mit"]),
    "mit-0": (["mit no attribution license"], ["mit-0"], ["opensource.org/licenses/mit-0"]),
    "bsd-2-clause": (["(?:simplified |2-clause |two-clause )bsd license", "bsd 2-clause license"], ["bsd-2-clause"], ["opensource.org/licenses/bsd-2-clause"]),
    "bsd-3-clause": (["(?:new |modified |revised |3-clause |three-clause )bsd license", "bsd 3-clause license"], ["bsd-3-clause"], ["opensource.org/licenses/bsd-3-clause"]),
    "bsd-4-clause": (["(?:original |4-clause )bsd license", "bsd 4-clause license"], ["bsd-4-clause"], []),
    "0bsd": (["zero-clause bsd license"], ["0bsd"], ["opensource.org/licenses/0bsd"]),
    "isc": (["isc license"], ["isc"], ["opensource.org/licenses/isc"]),
    "mpl-1.1": (["mozilla public license,? (?:version |v)?1\\.1"], ["mpl-1.1"], ["mozilla.org/mpl/1.1"]),
    "mpl-2.0": (["mozilla public license,? (?:version |v)?2(?:\\.0)?"], ["mpl-2.0"], ["mozilla.org/mpl/2.0"]),
    "epl-1.0": (["eclipse public license,? (?:version |v)?1(?:\\.0)?"], ["epl-1.0"], ["eclipse.org/legal/epl-v10"]),
    "epl-2.0": (["eclipse public license,? (?:version |v)?2(?:\\.0)?"], ["epl-2.0"], ["eclipse.org/legal/epl-2.0"]),
    "eupl-1.1": (["european union public licen[cs]e,? (?:version |v)?1\\.1", "eupl,? (?:version |v)?1\\.1"], ["eupl-1.1"], []),
    "eupl-1.2": (["european union public licen[cs]e,? (?:version |v)?1\\.2", "eupl,? (?:version |v)?1\\.2"], ["eupl-1.2"], []),
    "ms-pl": (["microsoft public license"], ["ms-pl"], ["opensource.org/licenses/ms-pl"]),
    "ms-rl": (["microsoft reciprocal license"], ["ms-rl"], ["opensource.org/licenses/ms-rl"]),
    "afl-3.0": (["academic free license,? (?:version |v)?3(?:\\.0)?"], ["afl-3.0"], ["opensource.org/licenses/afl-3.0"]),
    "osl-3.0": (["open software license,? (?:version |v)?3(?:\\.0)?"], ["osl-3.0"], ["opensource.org/licenses/osl-3.0"]),
    "cpl-1.0": (["common public license,? (?:version |v)?1(?:\\.0)?"], ["cpl-1.0"], ["opensource.org/licenses/cpl1.0"]),
    "ncsa": (["university of illinois/ncsa open source license"], ["ncsa"], ["opensource.org/licenses/ncsa"]),
    "blueoak-1.0.0": (["blue oak model license"], ["blueoak-1.0.0"], ["blueoakcouncil.org/license/1.0.0"]),
    "sspl-1.0": (["server side public license"], ["sspl-1.0"], ["mongodb.com/licensing/server-side-public-license"]),
    "busl-1.1": (["business source license,? (?:version |v)?1\\.1"], ["busl-1.1"], ["mariadb.com/bsl11"]),
    "elastic-2.0": (["elastic license,? (?:version |v)?2(?:\\.0)?"], ["elastic-2.0"], ["elastic.co/licensing/elastic-license"]),
    "cecill-2.1": (["cecill,? (?:version |v)?2\\.1"], ["cecill-2.1"], []),
    "upl-1.0": (["universal permissive license"], ["upl-1.0"], ["opensource.org/licenses/upl"]),
    "polyform-noncommercial-1.0.0": (["polyform noncommercial license"], ["polyform-noncommercial-1.0.0"], ["polyformproject.org/licenses/noncommercial/1.0.0"]),
    "cddl-1.0": (["common development and distribution license"], ["cddl-1.0"], ["opensource.org/licenses/cddl-1.0"]),
    "artistic-2.0": (["artistic license,? (?:version |v)?2(?:\\.0)?"], ["artistic-2.0"], ["opensource.org/licenses/artistic-2.0"]),
    "bsl-1.0": (["boost software license"], ["bsl-1.0"], ["boost.org/license_1_0"]),
    "zlib": (["zlib license"], ["zlib"], ["opensource.org/licenses/zlib"]),
    "wtfpl": (["do what the fuck you want to public license"], ["wtfpl"], ["wtfpl.net"]),
    "unlicense": (["the unlicense"], ["unlicense"], ["unlicense.org"]),
    "ofl-1.1": (["sil open font license"], ["ofl-1.1"], ["scripts.sil.org/ofl"]),
    "postgresql": (["postgresql license"], ["postgresql"], ["opensource.org/licenses/postgresql"]),
    "psf-2.0": (["python software foundation license"], ["psf-2.0", "python-2.0"], ["docs.python.org/license"]),
    "openssl": (["openssl license"], ["openssl"], []),
    "odbl-1.0": (["open database licen[cs]e"], ["odbl-1.0"], ["opendatacommons.org/licenses/odbl"]),
    "odc-by-1.0": (["open data commons attribution licen[cs]e"], ["odc-by-1.0"], ["opendatacommons.org/licenses/by"]),
    "pddl-1.0": (["public domain dedication and licen[cs]e"], ["pddl-1.0"], ["opendatacommons.org/licenses/pddl"]),
    "ogl-uk-3.0": (["open government licen[cs]e,? (?:version |v)?3(?:\\.0)?"], ["ogl-uk-3.0"], ["nationalarchives.gov.uk/doc/open-government-licence"]),
    "cc0-1.0": (["cc0(?: 1\\.0)?(?: universal)?", "creative commons zero"], ["cc0-1.0"], ["creativecommons.org/publicdomain/zero"]),
    "cc-pdm-1.0": (["public domain mark(?: 1\\.0)?"], ["cc-pddc"], ["creativecommons.org/publicdomain/mark"]),
    "public-domain": (["(?<!not\\s)(?<!never\\s)(?:in|into) the public domain"], [], []),
    "all-rights-reserved": (["all rights reserved"], [], []),
    "proprietary": (["proprietary and confidential"], [], []),
    "llama-community": (["llama \\d+ community license"], ["llama3", "llama2"], []),
    "openrail": (["(?:creativeml |bigscience )?open ?rail(?:-m)?(?: license)?"], ["openrail", "bigscience-openrail-m", "creativeml-openrail-m"], []),
}
# The parts and versions of Creative Commons licences; each pair is a licence.
CC_PARTS = ["by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"]
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
CC_WORDS = {"by": "attribution", "sa": "share[- ]?alike", "nd": "no[- ]?deriv(?:ative)?s?(?: works)?", "nc": "non[- ]?commercial"}
# Label -> names without a version. Not where a version follows, which has a rule of its own.
FAMILIES = {
    "gpl": ["gnu general public licen[cs]e", "gnu gpl", "gpl licen[cs]e"],
    "gpl-2.0": ["gnu gpl,? (?:version |v)?2(?:\\.0)?", "gpl,? (?:version |v)2(?:\\.0)?"],
    "gpl-3.0": ["gnu gpl,? (?:version |v)?3(?:\\.0)?", "gpl,? (?:version |v)3(?:\\.0)?"],
    "lgpl": ["gnu (?:lesser|library) general public licen[cs]e", "gnu lgpl", "lgpl licen[cs]e"],
    "agpl": ["(?:gnu )?affero general public licen[cs]e", "gnu agpl", "agpl licen[cs]e"],
    "fdl": ["gnu free documentation licen[cs]e"],
    "mpl": ["mozilla public licen[cs]e"],
    "epl": ["eclipse public licen[cs]e"],
    "eupl": ["european union public licen[cs]e"],
    "artistic": ["artistic licen[cs]e"],
    "bsd": ["bsd[- ]style licen[cs]e", "bsd licen[cs]e"],
    "cc": ["creative commons licen[cs]e"],
}
# Label -> sentences that only the body or the standard notice of the licence holds.
BODIES = {
    "mit": ["permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"],
    "isc": ["permission to use, copy, modify,? (?:and/or|and) distribute this software for any purpose with or without fee is hereby granted"],
    "bsd": ["redistribution and use in source and binary forms,? with or without modification,? are permitted provided that the following conditions are met"],
    "bsd-3-clause": ["neither the names? of [\\s\\S]{1,120}? nor the names of (?:its|their|the) contributors may be used to endorse or promote products"],
    "bsd-4-clause": ["all advertising materials mentioning features or use of this software must display the following acknowledge?ment"],
    "apache-2.0": ["you may not use this file except in compliance with the license", "subject to the terms and conditions of this license, each contributor hereby grants to you a perpetual"],
    "gpl": ["this program is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu general public license",
            "everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed"],
    "lgpl": ["this library is free software[:;,] you can redistribute it and/or modify it under the terms of the gnu (?:lesser|library) general public license"],
    "agpl": ["if you modify the program, your modified version must prominently offer all users interacting with it remotely"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public license, v\\. 2\\.0"],
    "mpl-1.1": ["the contents of this file are subject to the mozilla public license version 1\\.1"],
    "epl": ["the accompanying program is provided under the terms of this eclipse public license", "accompanying materials are made available under the terms of the eclipse public license"],
    "bsl-1.0": ["permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation"],
    "zlib": ["this software is provided (?:.{1,3})as-is(?:.{1,3}), without any express or implied warranty\\. in no event will the authors be held liable"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "cc0-1.0": ["to the extent possible under law, [\\s\\S]{1,120}? waived all copyright and related or neighboring rights"],
    "ofl-1.1": ["this font software is licensed under the sil open font license"],
    "wtfpl": ["you just do what the fuck you want to"],
}
# Further written rules, label -> sentences of notices, grants, conditions and disclaimers.
NOTICES = {
    "mit": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
            "distributed under the mit software license", "use of this source code is governed by an mit-style license"],
    "bsd": ["use of this source code is governed by a bsd-style license", "redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
            "redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer",
            "all rights reserved\\. use of this source code is governed by a bsd"],
    "bsd-3-clause": ["neither the name of [^\\n]{1,80} may be used to endorse or promote products derived from this software", "neither the name of the copyright holder nor the names of its contributors may be used"],
    "bsd-2-clause": ["licensed under the simplified bsd license", "this software is released under the 2-clause bsd"],
    "bsd-4-clause": ["this product includes software developed by the university of california, berkeley and its contributors"],
    "0bsd": ["permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\\.[\\s\\S]{0,40}the software is provided"],
    "apache-2.0": ["unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an .{0,3}as is.{0,3} basis",
                   "licensed to the apache software foundation \\(asf\\) under one or more contributor license agreements", "see the license for the specific language governing permissions and limitations under the license",
                   "the asf licenses this file to you under the apache license"],
    "apache-1.1": ["this product includes software developed by the apache software foundation", "products derived from this software may not be called .{0,3}apache.{0,3}"],
    "gpl": ["you should have received a copy of the gnu general public license along with this program"],
    "gpl-2.0": ["gnu general public license as published by the free software foundation[;,:] either version 2 of the license, or \\(at your option\\) any later version", "under the terms of the gnu general public license version 2 as published by the free software foundation"],
    "gpl-3.0": ["gnu general public license as published by the free software foundation[;,:] either version 3 of the license, or \\(at your option\\) any later version", "the gnu general public license is a free, copyleft license for software and other kinds of works"],
    "lgpl": ["you should have received a copy of the gnu (?:lesser|library) general public license along with this library", "this library is distributed in the hope that it will be useful, but without any warranty"],
    "lgpl-2.1": ["gnu lesser general public license as published by the free software foundation[;,:] either version 2\\.1 of the license, or \\(at your option\\) any later version"],
    "agpl": ["you should have received a copy of the gnu affero general public license along with this program", "remote network interaction; use with the gnu general public license"],
    "lgpl-3.0": ["gnu lesser general public license as published by the free software foundation[;,:] either version 3 of the license"],
    "agpl-3.0": ["gnu affero general public license as published by the free software foundation[;,:] either version 3 of the license", "the gnu affero general public license is a free, copyleft license for software and other kinds of works"],
    "fdl": ["permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license", "with no invariant sections, no front-cover texts,? and no back-cover texts"],
    "mpl-2.0": ["if a copy of the mpl was not distributed with this file, you can obtain one at", "incompatible with secondary licenses.{0,3}, as defined by the mozilla public license"],
    "mpl-1.1": ["software distributed under the license is distributed on an .{0,3}as is.{0,3} basis, without warranty of any kind, either express or implied\\. see the license for the specific language governing rights"],
    "epl-1.0": ["any use, reproduction or distribution of the program constitutes recipient's acceptance of this agreement"],
    "epl-2.0": ["this source code may also be made available under the following secondary licenses"],
    "eupl": ["licensed under the eupl", "unless required by applicable law or agreed to in writing, software distributed under the licence is distributed"],
    "cddl-1.0": ["the contents of this file are subject to the terms of the common development and distribution license", "you can obtain a copy of the license at usr/src/opensolaris\\.license", "when distributing covered code, include this cddl header"],
    "ms-pl": ["if you use the software, you accept this license\\. if you do not accept the license, do not use the software"],
    "artistic": ["you may distribute under the terms of either the gnu general public license or the artistic license", "the copyright holder maintains some semblance of artistic control", "it under the same terms as perl itself"],
    "artistic-2.0": ["this license establishes the terms under which a given free software package may be copied, modified, distributed, and/or redistributed"],
    "bsl-1.0": ["distributed under the boost software license, version 1\\.0", "unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor"],
    "zlib": ["the origin of this software must not be misrepresented; you must not claim that you wrote the original software", "altered source versions must be plainly marked as such"],
    "unlicense": ["anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "in jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest"],
    "wtfpl": ["everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed"],
    "ofl-1.1": ["the goals of the open font license \\(ofl\\) are to stimulate worldwide development of collaborative font projects", "no modified version of the font software may use the reserved font name"],
    "postgresql": ["permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"],
    "psf-2.0": ["psf hereby grants licensee a nonexclusive, royalty-free, world-wide license", "psf is making python available to licensee on an .{0,3}as is.{0,3} basis"],
    "openssl": ["this product includes software developed by the openssl project", "this product includes cryptographic software written by eric young"],
    "ncsa": ["permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \\(the .software.\\), to deal with the software"],
    "x11": ["except as contained in this notice, the name of the x consortium shall not be used in advertising", "x window system is a trademark of x consortium"],
    "hpnd": ["permission to use, copy, modify,? and distribute this software and its documentation for any purpose (?:and without fee )?is hereby granted,? provided that the above copyright notice appears? in all copies"],
    "ijg": ["this software is based in part on the work of the independent jpeg group"],
    "libpng": ["the png reference library is supplied .{0,3}as is"],
    "curl": ["except as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote the sale"],
    "icu": ["provided that the above copyright notice\\(s\\) and this permission notice appear in all copies of the software and that both the above copyright notice\\(s\\)"],
    "unicode": ["unicode data files or software without restriction", "distributed under the terms of use in https?://www\\.unicode\\.org/copyright\\.html"],
    "ruby": ["you may make and give away verbatim copies of the source form of the software without restriction", "ruby is copyrighted free software by yukihiro matsumoto"],
    "php": ["this product includes php software, freely available from", "products derived from this software may not be called .{0,3}php"],
    "vim": ["vim is charityware"],
    "beerware": ["if we meet some day, and you think this stuff is worth it, you can buy me a beer in return"],
    "json": ["the software shall be used for good, not evil"],
    "sspl-1.0": ["if you make the functionality of the program or a modified version available to third parties as a service, you must make the service source code available"],
    "busl-1.1": ["effective on the change date, or the fourth anniversary of the first publicly available distribution"],
    "elastic-2.0": ["you may not provide the software to third parties as a hosted or managed service"],
    "commons-clause": ["the license does not grant to you,? the right to sell the software", "commons clause. license condition v1\\.0"],
    "polyform-noncommercial-1.0.0": ["any noncommercial purpose is a permitted purpose"],
    "blueoak-1.0.0": ["this license gives everyone as much permission to work with this software as possible, while protecting contributors from liability"],
    "cc0-1.0": ["the person who associated a work with this deed has dedicated the work to the public domain", "no copyright[.,]? the person who associated a work"],
    "cc": ["this work is licensed under a creative commons", "some rights reserved.{0,40}creative commons", "creative commons corporation is not a law firm and does not provide legal services"],
    "cc-by": ["you are free to share and adapt this (?:work|material).{0,80}as long as you give appropriate credit", "distributed under the terms of the creative commons attribution license"],
    "cc-by-sa": ["text is available under the creative commons attribution-sharealike license", "if you remix, transform, or build upon the material, you must distribute your contributions under the same license"],
    "cc-by-nc": ["you may not use the material for commercial purposes"],
    "cc-by-nd": ["if you remix, transform, or build upon the material, you may not distribute the modified material"],
    "odbl-1.0": ["is made available under the open database license", "any rights in individual contents of the database are licensed under the database contents license"],
    "odc-by-1.0": ["is made available under the open data commons attribution license"],
    "ogl-uk-3.0": ["contains public sector information licensed under the open government licence v3\\.0"],
    "etalab-2.0": ["licence ouverte / open licence", "licence ouverte,? version 2\\.0"],
    "dl-de-by-2.0": ["datenlizenz deutschland (?:-|–) namensnennung (?:-|–) version 2\\.0"],
    "us-government-work": ["this is a work of the u(?:nited states|\\.s\\.) government and is not subject to copyright protection"],
    "public-domain": ["this (?:work|file|code|software) (?:is|has been) (?:dedicated|released) to the public domain", "i hereby place this (?:work|file|code|software) in the public domain",
                      "the authors? disclaims? copyright to this source code", "no copyright is claimed in the united states"],
    "llama-community": ["licensed under the llama \\d(?:\\.\\d)? community license, copyright", "built with meta llama 3"],
    "openrail": ["use restrictions:? you agree not to use the model or derivatives of the model"],
    "gemma": ["gemma is provided under and subject to the gemma terms of use"],
    "proprietary": ["unauthori[sz]ed copying of this file,? via any medium,? is strictly prohibited", "this (?:software|document|material) (?:is|contains) (?:the )?(?:proprietary|confidential) (?:and (?:proprietary|confidential) )?(?:information|property) of",
                    "no part of this (?:publication|book|document) may be reproduced,? (?:stored in a retrieval system|distributed),? or transmitted",
                    "may not be reproduced,? in whole or in part,? without (?:the )?(?:prior|express) written (?:permission|consent)"],
    "free-documentation": ["this document may be reproduced or distributed in any form without prior permission"],
    "noai": ["may not be used (?:for|in) (?:the )?(?:training|development) of (?:artificial intelligence|machine learning|ai)", "text and data mining,? ai training,? and similar technologies are reserved"],
}
BODY = ("body", 55, 0.97)
# Where an identifier ends: a full stop that ends a sentence is no part of it.
ID_END = r"(?![\w+-]|\.\w)"
# Other operands of a licence expression that stand before an identifier: "(MIT OR (Apache-2.0 AND ISC))".
OPERANDS = r"\s*\(*(?:[\w.+-]+\)*\s+(?:or|and|with)\s+\(*)*"
# An identifier that ends in a version is one in running text too; "mit" or "zlib" is one only beside it.
VERSIONED = r"(?:l|a)?gpl-\d(?:\.\d)?(?:-only|-or-later)?\+?|(?:apache|mpl|epl|bsl|ofl|eupl|cddl|artistic|afl|osl|cc0)-\d\.\d|bsd-[234]-clause|cc-by(?:-sa|-nd|-nc)*-\d\.\d"
# Where a pattern names the group "at", that group is the place of the detection.
# Words without which a phrasing can't occur; a rule is tried where its keyword and one of them stand.
FRAME_WORDS = {"tag": ["spdx-license-identifier"], "field": ["license", "licence"], "either": ["or", "and"], "other": ["or", "and"],
               "address": ["http"], "grant": ["under"], "subject": ["subject"]}
# Phrasing -> (pattern around a name or identifier {0}, {1} being the other operand, which of both, priority, confidence).
PHRASINGS = {
    "tag": (r"spdx-license-identifier:" + OPERANDS + r"(?P<at>{0})" + ID_END, "id", 50, 0.99),
    "either": (r"(?<![\w.+/-])(?P<at>{0})(?=\)?\s+(?:or|and)\s+\(?(?:{1})" + ID_END + r")", "id", 42, 0.9),
    "other": (r"(?<![\w.+/-])(?:{1})\)?\s+(?:or|and)\s+\(?(?P<at>{0})" + ID_END, "id", 42, 0.9),
    "field": (r"licen[cs]e\s*[:=]\s*[\"']?{0}" + ID_END, "id", 45, 0.9),
    "address": (r"https?://(?:www\.)?{0}", "url", 40, 0.95),
    "grant": (r"(?:licensed|released|distributed|published|available)\s+(?:\w+\s+)?under\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{0}(?![\w])", "name", 35, 0.95),
    "subject": (r"subject\s+to\s+(?:the\s+)?(?:terms\s+of\s+)?(?:the\s+)?{0}(?![\w])", "name", 30, 0.85),
    "mention": (r"(?<![\w-]){0}(?![\w])", "name", 10, 0.6),
}


@dataclass(frozen=True)
class Rule:
    label: str
    phrasing: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


def _keyword(pattern: str) -> str:
    """The longest literal word of a pattern, without what is optional or an alternative (words
    may stand on different lines of a text, so a keyword never holds white space)."""
    flat = re.sub(r"\\[()]", "\0", pattern.replace("\\.", "\1"))
    flat = re.sub(r"\((?:[^()]|\([^()]*\))*\)(?:\?|\{[^}]*\})?|\[[^\]]*\](?:\{[^}]*\})?[?+*]*|\\[dswWn][?+*]*|.\{[^}]*\}\??|.[?*]", "\0", flat)
    runs = [r.replace("\1", ".") for r in re.split(r"[\0\\+|;']", flat)]
    return max((w for r in runs for w in r.split()), key=len)


def build_rules() -> list[Rule]:
    table_ = dict(LICENSES)
    for part in CC_PARTS:
        words = part.replace("-", "[- ]")
        for version in CC_VERSIONS:
            spelled = "[- ]".join(CC_WORDS[x] for x in part.split("-"))
            names = [f"cc[- ]{words}[- ]{re.escape(version)}", f"(?:creative commons|cc) {spelled},? (?:version |v)?{re.escape(version)}"]
            table_[f"cc-{part}-{version}"] = (names, [f"cc-{part}-{version}"], [f"creativecommons.org/licenses/{part}/{version}"])
    rules = []
    known = "|".join(re.escape(i) for _, ids, _ in table_.values() for i in ids)
    for label, (names, ids, urls) in table_.items():
        for phrasing, (frame, what, priority, confidence) in PHRASINGS.items():
            for x in {"name": names, "id": [re.escape(i) + plus(i) for i in ids], "url": [re.escape(u) for u in urls]}[what]:
                literal = x.removesuffix(PLUS).replace("\\-", "-").replace("\\.", ".").replace("\\+", "+")
                keyword = _keyword(x) if what == "name" else literal.replace("\\", "")
                if what == "name" and label.startswith("cc-by"):
                    keyword = label.rsplit("-", 1)[1]
                other = known if re.fullmatch(VERSIONED, literal) else VERSIONED
                rules.append(Rule(label, phrasing, priority, confidence, keyword, frame.replace("{1}", other).replace("{0}", x.replace(" ", r"\s+"))))
    return rules + more_rules()


PLUS = r"\+?"


def plus(identifier: str) -> str:
    """GNU identifiers without a suffix may end in a plus (or any later version)."""
    return PLUS if re.fullmatch(r"(?:l|a)?gpl-[\d.]+|gfdl-[\d.]+", identifier) else ""


def more_rules() -> list[Rule]:
    """Families without a version, and the written rules: sentences of licence bodies."""
    rules = []
    for label, names in FAMILIES.items():
        for x in names:
            for phrasing, (frame, what, priority, confidence) in PHRASINGS.items():
                if what == "name":       # below the versioned rule of the same phrasing
                    rules.append(Rule(label, phrasing, priority - 1, confidence, _keyword(x), frame.replace("{0}", x.replace(" ", r"\s+"))))
    for label, sentences in [*BODIES.items(), *NOTICES.items()]:
        for x in sentences:              # a body may be wrapped as a comment
            rules.append(Rule(label, BODY[0], BODY[1], BODY[2], _keyword(x), x.replace(" ", r"[\s*#/]+")))
    return rules


WORD = rb"[0-9a-z\x80-\xff]+"
NOT_WORD = rb"[^0-9a-z\x80-\xff]+"


class Scanner:
    """Scans lower-cased UTF-8. Bytes from 0x80 up belong to characters outside ASCII, so word
    borders in bytes and in characters are the same."""

    def __init__(self):
        import ahocorasick

        self.words = re.compile(WORD)
        self.base = [(re.compile(rb"(?<![0-9a-z\x80-\xff])" + NOT_WORD.join(p.encode().split()) + rb"(?![0-9a-z\x80-\xff])"), p.split()[0].encode(), p.split()[-1].encode(), label)
                     for p, label in BASE.items()]
        self.rules = [(r, re.compile(r.pattern.encode())) for r in build_rules()]
        self.gate = ahocorasick.Automaton()
        self.by_key: dict[str, list[int]] = {}
        for i, (r, _) in enumerate(self.rules):
            self.by_key.setdefault(r.keyword, []).append(i)
        for k in {*self.by_key, *(w for words in FRAME_WORDS.values() for w in words)}:
            self.gate.add_word(k, k)
        self.gate.make_automaton()

    def candidates(self, low: bytes) -> list[int]:
        """Rules whose keyword occurs, and one of the words of their phrasing."""
        there = {k for _, k in self.gate.iter(low.decode("latin-1"))}
        frames = {p for p, words in FRAME_WORDS.items() if there.isdisjoint(words)}
        return sorted(i for k in there & self.by_key.keys() for i in self.by_key[k] if self.rules[i][0].phrasing not in frames)

    def matches(self, i: int, low: bytes) -> list[tuple[int, int, Rule]]:
        rule, pattern = self.rules[i]
        group = "at" if "at" in pattern.groupindex else 0
        return [(*m.span(group), rule) for m in pattern.finditer(low)]

    def detections(self, low: bytes) -> list[tuple[int, int, Rule]]:
        """Accepted detections (start, end, rule) in order of place."""
        return resolve([d for i in self.candidates(low) for d in self.matches(i, low)])

    def scan(self, text: str) -> tuple:
        """(n_words, n_base, first_word, last_word, base_labels, labels, score)"""
        low = text.encode().lower()          # bytes.lower() changes A-Z only
        n_words = len(self.words.findall(low))
        places, base = [], []
        for pattern, first, last, label in self.base:
            if first in low and last in low:
                found = [m.span() for m in pattern.finditer(low)]
                places += found
                base += [label] * bool(found)
        kept = self.detections(low)
        # A base place inside an accepted detection counts once with it, by the greater confidence.
        starts = [lo for lo, _, _ in kept]
        sure = [r.confidence for _, _, r in kept]
        miss = 1.0
        for lo, hi in places:
            i = bisect_right(starts, lo) - 1
            if i >= 0 and hi <= kept[i][1]:
                sure[i] = max(sure[i], BASE_CONFIDENCE)
            else:
                miss *= 1 - BASE_CONFIDENCE
        for c in sure:
            miss *= 1 - c
        at = [len(self.words.findall(low, 0, p[0])) for p in (min(places), max(places))] if places else [None, None]
        labels = sorted({*base, *(r.label for _, _, r in kept)})
        return n_words, len(places), *at, ",".join(sorted(set(base))), ",".join(labels), round(1 - miss, 6)


def resolve(found: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Suppress detections that lie inside an accepted one or overlap one of higher priority."""
    kept: list[tuple[int, int, Rule]] = []
    starts: list[tuple[int, int, Rule]] = []
    order = sorted(found, key=lambda d: (-d[2].priority, d[0] - d[1], d[0], d[2].label, d[2].phrasing))
    for d in order:                       # accepted ones never overlap, so neighbours suffice
        i = bisect_left(starts, d[0], key=lambda x: x[0])
        if any(0 <= j < len(starts) and starts[j][0] < d[1] and d[0] < starts[j][1] for j in (i - 1, i)):
            continue
        insort(starts, d, key=lambda x: x[0])
        kept.append(d)
    return sorted(kept, key=lambda d: d[0])


COLUMNS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) per row."""
    kind = df.schema[id_col].dataType.simpleString()
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def make():
        scan = Scanner().scan

        def work(b: pa.RecordBatch) -> pa.RecordBatch:
            cols = zip(*map(scan, b.column(1).to_pylist()), strict=True)
            return pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=["id", *names])

        return work

    rows = df.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    return by_batch(rows, f"id {kind}, {COLUMNS}", make).withColumnRenamed("id", id_col)


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
