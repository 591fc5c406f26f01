"""License statements by ordered signature rules, in DataFrame expressions only.

Every rule is a regular expression over the canonical form of a text (its
lower-cased words, each after one space), with a keyword, a priority and a
label. A text is looked at only when it holds one of the gate words that every
rule implies; of the rules only those whose keyword occurs are tried. Matches
are word intervals; one that lies inside another of at least its priority is
dropped. All of it happens within the row: nothing is shuffled.

Results: null and empty texts have 0 words and places, null first and last
words, empty labels and score 0; repeated rows are scanned alike; of equal
intervals of one priority the first rule wins; texts are scanned whole; an empty
table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logassay.llm.common import texts_of

OUTSIDE = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# The phrases every scan counts, and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Repeats are possessive, which Java runs in a loop; others recurse, and a long run of numbers
# would end the stack. Each turn ends with a word, so nothing has to be given back.
NUMBERS = r"(?: \d+(?= ))*+"

# Hand-written names: label, expression over canonical words, a word it implies.
NAMES = (
    ("apache", "apache(?: software)?(?: foundation)?", "apache"),
    ("mit", "(?:mit|expat)", ""),
    ("bsd", r"(?:(?:\d|two|three|four) clause |new |modified |simplified |revised )?bsd(?: \d clause)?", "bsd"),
    ("gnu-gpl", "(?:gnu )?(?:gpl|general public)", "g"),
    ("gnu-lgpl", "(?:gnu )?(?:lgpl|(?:lesser|library) general public)", "l"),
    ("gnu-agpl", "(?:gnu )?(?:agpl|affero general public)", "a"),
    ("gnu-fdl", "(?:gnu )?(?:gfdl|fdl|free documentation)", "f"),
    ("mozilla", "(?:mozilla public|mozilla|mpl)", "m"),
    ("eclipse", "(?:eclipse public|eclipse|epl)", "e"),
    ("cddl", "(?:common development and distribution|cddl)", "c"),
    ("common-public", "(?:common public|cpl)", "c"),
    ("artistic", "(?:perl )?artistic", "artistic"),
    ("isc", "(?:isc|internet systems consortium)", "i"),
    ("zlib", "(?:zlib libpng|zlib)", "zlib"),
    ("boost", "boost(?: software)?", "boost"),
    ("unlicense", "(?:unlicense|the unlicense)", "unlicense"),
    ("wtfpl", "(?:wtfpl|wtf public|do what the fuck you want to public)", "w"),
    ("cc-by-nc", "(?:cc by nc|creative commons attribution non ?commercial)", "c"),
    ("cc-by-nc-sa", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)", "c"),
    ("cc-by-nc-nd", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)", "c"),
    ("cc-by-sa", "(?:cc by sa|creative commons attribution share ?alike)", "c"),
    ("cc-by-nd", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)", "c"),
    ("cc-attribution", "creative commons attribution", "creative commons"),
    ("cc-zero", "(?:cc0|cc 0|cc zero|creative commons zero)", "c"),
    ("open-database", "(?:odbl|open database|odc open database)", "o"),
    ("odc-by", "(?:odc by|open data commons attribution)", "o"),
    ("pddl", "(?:pddl|(?:odc )?public domain dedication and)", "p"),
    ("open-font", "(?:sil )?(?:ofl|open font)", "o"),
    ("eupl", "(?:european union public|eupl)", "e"),
    ("ms-public", "(?:microsoft public|ms pl)", "m"),
    ("ms-reciprocal", "(?:microsoft reciprocal|ms rl)", "m"),
    ("python", "(?:python software foundation|python|psf)", "p"),
    ("php", "php", "php"),
    ("ruby", "ruby", "ruby"),
    ("postgresql", "postgre(?:s|sql)", "postgre"),
    ("openssl", "openssl(?: ssleay)?", "openssl"),
    ("openrail", "(?:creativeml )?(?:bigscience )?open ?rail(?: m)?", "rail"),
    ("llama", rf"llama{NUMBERS}(?: community)?", "llama"),
    ("cecill", "cecill(?: [bc])?", "cecill"),
    ("unicode", "unicode(?: dfs)?(?: inc)?", "unicode"),
    ("academic-free", "(?:academic free|afl)", "a"),
    ("open-software", "(?:open software|osl)", "o"),
    ("vim", "vim", "vim"),
    ("x11", "x11", "x11"),
    ("ncsa", "(?:university of illinois )?(?:ncsa|illinois)(?: open source)?", "n"),
    ("sleepycat", "sleepycat", "sleepycat"),
    ("proprietary", "(?:proprietary|commercial|enterprise)", "r"),
    ("royalty-free", "royalty free", "royalty"),
)
VERSION = (
    rf"(?: (?:version|v) ?\d+{NUMBERS}| v?\d+{NUMBERS})?"
    r"(?: (?:international|unported|only|or later)(?= ))*+"
)
THE = "(?:the )?(?:terms of (?:the )?)?"
LICENSE = "licen[cs]e"
# Hand-written ways to state a name: expression around it, priority, keyword.
FORMS = (
    (f"spdx {LICENSE} identifier {{}}{VERSION}", 4, "spdx"),
    (f"(?:dual )?licen[cs]ed under {THE}{{}}(?: {LICENSE})?{VERSION}", 3, "ed under"),
    (f"released under {THE}{{}} {LICENSE}{VERSION}", 3, "released under"),
    (f"(?:distributed|available|published|provided|shared) under {THE}{{}} {LICENSE}{VERSION}", 3, "under"),
    (f"subject to {THE}{{}} {LICENSE}{VERSION}", 3, "subject to"),
    (f"governed by {THE}{{}} {LICENSE}{VERSION}", 3, "governed by"),
    (f"{{}} {LICENSE}{VERSION}", 2, "licen"),
    (f"{LICENSE}(?: is)? {{}}{VERSION}", 2, "licen"),
)
# Hand-written signatures of license texts and notices.
TEXTS = (
    ("mit", "permission is hereby granted free of charge to any person", 4, "permission"),
    ("isc", "permission to use copy modify and or distribute this software", 4, "permission"),
    ("bsd", "redistributions? of source code must retain the above copyright notice", 4, "copyright"),
    ("bsd", "redistribution and use in source and binary forms", 4, "redistribution"),
    ("no-warranty", "provided as is without warranty of any kind", 2, "warranty"),
    ("no-warranty", "without (?:even the implied )?warranty of (?:any kind|merchantability)", 1, "warranty"),
    ("public-domain", "(?:dedicated to|released (?:in)?to|in) the public domain", 2, "public domain"),
    ("copyright", r"copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d(?= ))*+", 2, "copyright"),
    ("copyright", "copyright (?:c |holders?|owners?|notice)", 1, "copyright"),
    ("copyleft", "copyleft", 1, "copyleft"),
    ("rights-reserved", "(?:all|some|no) rights (?:are )?reserved", 1, "reserved"),
    ("cc-by-nc", f"cc by nc{VERSION}", 1, "cc by nc"),
    ("cc-by-nc-sa", f"cc by nc sa{VERSION}", 1, "cc by nc sa"),
    ("cc-by-nc-nd", f"cc by nc nd{VERSION}", 1, "cc by nc nd"),
    ("cc-by-sa", f"cc by sa{VERSION}", 1, "cc by sa"),
    ("cc-by-nd", f"cc by nd{VERSION}", 1, "cc by nd"),
    ("cc-attribution", f"cc by{VERSION}", 1, "cc by"),
    # Notices and grants, a sentence or a heading of each.
    ("apache", "apache license version 2 0 january 2004", 4, "apache license"),
    ("apache", "licensed under the apache license version 2 0 the license", 4, "apache license"),
    ("apache", "you may not use this file except in compliance with the license", 3, "compliance with the license"),
    ("apache", "you may obtain a copy of the license at", 2, "copy of the license"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license", 3, "under the license"),
    ("apache", "see the license for the specific language governing permissions", 3, "permissions"),
    ("apache", "licensed to the apache software foundation asf under one or more contributor license agreements", 4, "license agreements"),
    ("apache", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license", 4, "copyright license"),
    ("apache-1.1", "this product includes software developed by the apache (?:software foundation|group).{0,60}? (?:license|copyright)", 3, "apache"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions", 4, "permission notice"),
    ("mit", "the software is provided as is without warranty of any kind express or implied", 3, "warranty"),
    ("mit", "in no event shall the authors or copyright holders be liable for any claim damages or other liability", 3, "copyright holders"),
    ("mit-0", "mit no attribution license", 4, "no attribution"),
    ("x11", "except as contained in this notice the name of .{1,60}? shall not be used in advertising .{1,200}? without prior written permission", 3, "prior written"),
    ("hpnd", "permission to use copy modify (?:and )?distribute (?:and sell )?this software and its documentation for any purpose", 4, "permission to use"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice", 4, "copyright notice"),
    ("bsd-3-clause", "neither the name of .{1,80}? may be used to endorse or promote products derived from this software without specific prior written permission", 4, "prior written permission"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment .{1,300}? (?:copyright|redistribution|license)", 4, "advertising materials"),
    ("bsd", "this software is provided by the (?:copyright holders|regents|authors?)(?: and contributors)? as is and any express or implied warranties", 4, "warranties"),
    ("bsd", "in no event shall the copyright (?:holders?|owners?)(?: or contributors)? be liable for any direct indirect incidental special", 3, "copyright"),
    ("bsd-patent", "subject to the terms and conditions of this license each copyright holder and contributor hereby grants", 3, "copyright holder"),
    ("gnu-gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 4, "general public license"),
    ("gnu-gpl", "gnu general public license for more details", 3, "general public license"),
    ("gnu-gpl", "you should have received a copy of the gnu general public license", 3, "general public license"),
    ("gnu-gpl-2", "gnu general public license version 2 june 1991", 4, "general public license"),
    ("gnu-gpl-3", "gnu general public license version 3 29 june 2007", 4, "general public license"),
    ("gnu-gpl-2", "version 2 of the (?:gnu general public )?license", 3, "version 2 of the"),
    ("gnu-gpl-3", "version 3 of the (?:gnu general public )?license", 3, "version 3 of the"),
    ("gnu-gpl", "the licenses for most software are designed to take away your freedom to share and change it", 4, "licenses for most software"),
    ("gnu-gpl", "the gnu general public license is a free copyleft license for software and other kinds of works", 4, "copyleft license"),
    ("gnu-gpl-classpath", "linking this library statically or dynamically with other modules .{1,200}? (?:copyright|permission)", 3, "linking this library"),
    ("gnu-lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license", 4, "general public license"),
    ("gnu-lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license", 3, "general public license"),
    ("gnu-lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", 4, "general public license"),
    ("gnu-lgpl-3", "this version of the gnu lesser general public license incorporates the terms", 4, "general public license"),
    ("gnu-agpl", "you should have received a copy of the gnu affero general public license", 3, "affero general public license"),
    ("gnu-agpl", "gnu affero general public license version 3 19 november 2007", 4, "affero general public license"),
    ("gnu-fdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 4, "free documentation license"),
    ("gnu-fdl", "with no invariant sections no front cover texts and no back cover texts .{1,120}? license", 3, "invariant sections"),
    ("gnu-all-permissive", "copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice", 4, "without royalty"),
    ("mozilla", "this source code form is subject to the terms of the mozilla public license", 4, "mozilla public license"),
    ("mozilla", "if a copy of the mpl was not distributed with this file you can obtain one .{0,60}? licen[cs]e", 3, "copy of the mpl"),
    ("mozilla-1.1", "the contents of this file are subject to the mozilla public license version 1 1", 4, "mozilla public license"),
    ("netscape", "the contents of this file are subject to the netscape public license", 4, "netscape public license"),
    ("mozilla", "incompatible with secondary licenses", 2, "secondary licenses"),
    ("eclipse", "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse public license", 4, "eclipse public license"),
    ("eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license", 3, "eclipse public license"),
    ("eclipse-distribution", "eclipse distribution license", 3, "eclipse distribution"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", 4, "distribution license"),
    ("cddl", "when distributing covered code include this cddl header .{0,60}? license", 3, "covered code"),
    ("common-public", "the accompanying program is provided under the terms of this common public license", 4, "common public license"),
    ("ibm-public", "ibm public license", 3, "ibm public"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 4, "permission to use"),
    ("zero-bsd", "(?:zero clause bsd|0bsd) license", 3, "bsd license"),
    ("zlib", "permission is granted to anyone to use this software for any purpose including commercial applications", 4, "commercial applications"),
    ("zlib", "altered source versions must be plainly marked as such .{1,160}? notice may not be removed .{0,80}? redistribution", 3, "altered source"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", 4, "organization obtaining"),
    ("unlicense", "this is free and unencumbered software released into the public domain", 4, "unencumbered"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software .{1,200}? (?:copyright|domain)", 3, "anyone is free"),
    ("wtfpl", "everyone is permitted to copy and distribute verbatim or modified copies of this license document", 3, "license document"),
    ("gnu-license-text", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", 4, "license document"),
    ("beer-ware", "beer ?ware license", 3, "license"),
    ("beer-ware", "as long as you retain this notice you can do whatever you want with this stuff .{0,160}? (?:licen[cs]e|copyright)", 3, "retain this notice"),
    ("artistic", "the intent of this document is to state the conditions under which a package may be copied such that the copyright holder", 4, "copyright holder"),
    ("artistic", "the same terms as (?:the )?perl (?:5 )?(?:itself|programming language) .{0,60}? licen[cs]e", 2, "same terms as"),
    ("python", "psf is making python available to licensee on an as is basis", 4, "licensee"),
    ("python", "this license agreement is between the python software foundation", 4, "python software foundation"),
    ("php", "this source file is subject to version \\d(?: \\d+)? of the php license", 4, "php license"),
    ("openssl", "this product includes software developed by the openssl project .{0,80}? (?:license|copyright|redistribution)", 3, "openssl project"),
    ("postgresql", "in no event shall the university of california be liable to any party .{1,300}? (?:copyright|warrant|permission)", 3, "university of california"),
    ("ncsa", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers", 4, "following disclaimers"),
    ("open-font", "this font software is licensed under the sil open font license", 4, "open font license"),
    ("open-font", "the fonts and derivatives however cannot be released under any other type of license", 3, "type of license"),
    ("ubuntu-font", "ubuntu font licen[cs]e", 3, "ubuntu font"),
    ("cc-deed", "this work is licensed under a creative commons", 3, "creative commons"),
    ("cc-deed", "to view a copy of this license visit (?:https? )?(?:www )?creativecommons org", 3, "creativecommons"),
    ("cc-deed", "creativecommons org licenses", 3, "creativecommons"),
    ("cc-zero", "creativecommons org publicdomain zero", 4, "publicdomain"),
    ("cc-deed", "the work as defined below is provided under the terms of this creative commons public license", 4, "creative commons public"),
    ("cc-deed", "you are free to share copy and redistribute the material .{1,300}? licen[cs]", 2, "free to share"),
    ("cc-by", "you must give appropriate credit provide a link to the license and indicate if changes were made", 3, "appropriate credit"),
    ("cc-by-nc", "you may not use the material for commercial purposes .{0,200}? licen[cs]", 3, "commercial purposes"),
    ("cc-by-sa", "you must distribute your contributions under the same license as the original", 3, "same license as"),
    ("cc-by-nd", "you may not distribute the modified material .{0,200}? licen[cs]", 3, "modified material"),
    ("cc-zero", "has waived all copyright and related or neighboring rights", 4, "neighboring rights"),
    ("public-domain", "public domain dedication", 3, "public domain"),
    ("public-domain", "(?:no known copyright|no copyright) restrictions", 2, "copyright restrictions"),
    ("public-domain", "no rights reserved", 2, "rights reserved"),
    ("us-government", "works? of the (?:us|u s|united states) government .{0,120}? (?:copyright|public domain)", 2, "government"),
    ("open-government", "open government licen[cs]e", 3, "open government"),
    ("open-government", "contains public sector information licen[cs]ed under", 3, "sector information"),
    ("open-database", "this .{1,80}? is made available under the open database license", 4, "open database license"),
    ("open-database", "any rights in individual contents of the database are licensed under the database contents license", 4, "database contents license"),
    ("etalab", "(?:licence ouverte|open licence) (?:etalab|version)", 3, "licence"),
    ("microsoft-eula", "microsoft software license terms", 3, "software license terms"),
    ("ms-public", "if you use the software you accept this license if you do not accept the license do not use the software", 4, "accept this license"),
    ("oracle-binary", "oracle (?:binary code|technology network) license agreement", 3, "license agreement"),
    ("eula", "end user licen[cs]e agreement", 2, "end user"),
    ("eula", "by installing .{0,80}? you agree to be bound by .{0,80}? licen[cs]e", 2, "by installing"),
    ("business-source", "business source license", 3, "business source"),
    ("elastic", "elastic license", 3, "elastic license"),
    ("server-side-public", "server side public license", 3, "server side public"),
    ("commons-clause", "commons clause license condition", 4, "commons clause"),
    ("polyform", "polyform (?:noncommercial|small business|strict|shield|perimeter) license", 3, "polyform"),
    ("parity", "parity public license", 3, "parity public"),
    ("hippocratic", "hippocratic license", 3, "hippocratic"),
    ("json", "the software shall be used for good not evil .{0,200}? (?:warranty|licen[cs]e)", 3, "good not evil"),
    ("llama", "llama (?:2|3|3 1|3 2|3 3|4) community license agreement", 4, "community license"),
    ("llama", "built with (?:meta )?llama .{0,120}? licen[cs]e", 2, "built with"),
    ("openrail", "use based restrictions .{0,200}? licen[cs]e", 2, "based restrictions"),
    ("openrail", "bigscience rail license", 4, "rail license"),
    ("gemma", "gemma (?:terms of use|prohibited use policy) .{0,200}? licen[cs]", 2, "gemma"),
    ("falcon", "falcon llm license", 3, "falcon llm"),
    ("model-license", "(?:model|weights) licen[cs]e agreement", 2, "agreement"),
    ("research-only", "licen[cs]ed? (?:is )?(?:granted )?for (?:non commercial )?research (?:purposes )?only", 3, "research"),
    ("non-commercial", "for non ?commercial (?:use|purposes) only .{0,120}? (?:licen[cs]|permission|copyright)", 2, "commercial"),
    ("eupl", "licensed under the eupl", 3, "eupl"),
    ("eupl", "european union public licence", 3, "european union"),
    ("cecill", "this software is governed by the cecill(?: [abc])? license under french law", 4, "cecill"),
    ("mulan", "mulan (?:psl license|permissive software license|public license)", 3, "mulan"),
    ("upl", "universal permissive license", 3, "universal permissive"),
    ("blue-oak", "blue oak model license", 3, "blue oak"),
    ("ietf", "ietf trust and the persons identified as the document authors all rights reserved", 4, "ietf trust"),
    ("ietf", "code components extracted from this document must include simplified bsd license text", 4, "code components"),
    ("w3c", "w3c software (?:notice and|and document) license", 3, "w3c software"),
    ("w3c", "permission to copy modify and distribute this (?:software|work) and its documentation with or without modification for any purpose", 3, "permission to copy"),
    ("unicode", "unicode (?:inc )?license agreement data files and software", 4, "unicode"),
    ("ijg", "this software is based in part on the work of the independent jpeg group .{0,120}? (?:copyright|warrant|licen[cs]e)", 3, "jpeg group"),
    ("freetype", "freetype (?:project )?license", 3, "freetype"),
    ("libpng", "libpng license", 3, "libpng"),
    ("curl", "curl and libcurl are licensed under", 3, "libcurl"),
    ("sqlite", "the author disclaims copyright to this source code", 4, "disclaims copyright"),
    ("tcl", "the authors hereby grant permission to use copy modify distribute and license this software", 4, "hereby grant permission"),
    ("opengl", "sgi free software license b", 4, "sgi free software"),
    ("nist", "this software was developed .{1,120}? national institute of standards and technology .{1,300}? (?:copyright|domain|warrant)", 3, "national institute of standards"),
    ("wikipedia", "text is available under the creative commons attribution share ?alike license", 4, "text is available"),
    ("stack-exchange", "user contributions licensed under cc by sa", 4, "user contributions"),
    ("arxiv", "arxiv org perpetual non exclusive license", 4, "arxiv"),
    ("elsevier", "published by elsevier .{0,120}? (?:all rights reserved|open access article under the cc by)", 3, "elsevier"),
    ("springer", "the author(?: s)? (?:under exclusive licen[cs]e to|exclusive licensee) springer", 4, "springer"),
    ("open-access", "open access article (?:distributed )?under the (?:terms|conditions) of .{0,60}? licen[cs]e", 3, "open access"),
    ("permission-needed", "no part of this (?:publication|book|work|document) may be reproduced .{1,300}? permission", 3, "no part of this"),
    ("permission-needed", "reproduced with (?:the )?(?:kind )?permission", 2, "with"),
    ("permission-needed", "without (?:the )?(?:express |prior )?(?:express |prior )?written permission", 2, "written permission"),
    ("trademark", "trademarks? of their respective owners .{0,120}? (?:licen[cs]e|copyright|rights reserved|permission)", 1, "respective owners"),
    ("attribution-required", "attribution (?:is )?required .{0,60}? licen[cs]e", 1, "attribution"),
    ("warranty-disclaimer", "disclaims? all warranties", 1, "warranties"),
    ("warranty-disclaimer", "warrant(?:y|ies) of merchantability (?:and |or )?fitness for a particular purpose", 1, "particular purpose"),
    ("license-mention", f"(?:licen[cs]ed|{LICENSE} agreement|terms of (?:the |this )?{LICENSE})", 1, "licen"),
)
WEIGHTS = {4: 1.0, 3: 0.9, 2: 0.7, 1: 0.5}
# One of these is in every text that a rule or phrase can match; they are sought in the
# raw text, so none of them goes beyond one word.
GATE_WORDS = (
    "licen", "copyright", "copyleft", "reserved", "domain", "permission", "warrant", "redistribution", "spdx",
)
GATE_CC = rf"cc[{OUTSIDE}]+by"


def rules() -> list[tuple[str, int, str, str, str]]:
    """label, priority, keyword, a part of the name it implies (or nothing) and expression of every rule."""
    out = [
        (label, priority, keyword, implied if len(implied) > 1 else "", form.format(name))
        for label, name, implied in NAMES
        for form, priority, keyword in FORMS
    ]
    return out + [(label, priority, keyword, "", text) for label, text, priority, keyword in TEXTS]


def _rule_table() -> Column:
    rows = [
        {"id": i, "label": label, "p": priority, "kw": keyword, "name": implied, "re": f" ({text})(?= )"}
        for i, (label, priority, keyword, implied, text) in enumerate(rules())
    ]
    kind = "array<struct<id:int,label:string,p:int,kw:string,name:string,re:string>>"
    return F.from_json(F.lit(json.dumps(rows)), kind)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _matches(rule: Column) -> Column:
    """Word intervals of a rule: first and last words of each match carry a mark."""
    marked = F.split(F.regexp_replace("c", rule["re"], F.lit(" \x01$1\x02")), " ")
    place = lambda test: F.filter(
        F.transform(marked, lambda w, i: F.when(test(w), i - 1)), lambda i: i.isNotNull()
    )
    return F.transform(
        F.arrays_zip(
            place(lambda w: F.startswith(w, F.lit("\x01"))).alias("s"),
            place(lambda w: F.endswith(w, F.lit("\x02"))).alias("e"),
        ),
        lambda m: F.struct(
            m["s"].alias("s"), (-m["e"]).alias("e"), (-rule["p"]).alias("p"), rule["id"].alias("id"),
            rule["label"].alias("label"),
        ),
    )


def _surviving(found: Column) -> Column:
    """Labels and best priority of matches not inside one of at least their priority."""
    none = F.lit(-1)
    start = F.struct(
        *[none.alias(f"m{p}") for p in WEIGHTS],
        F.array().cast("array<string>").alias("labels"), F.lit(0).alias("best"),
    )

    def step(state: Column, m: Column) -> Column:
        end, priority = -m["e"], -m["p"]
        reach = F.greatest(*[F.when(priority <= p, state[f"m{p}"]).otherwise(none) for p in WEIGHTS])
        fresh = reach < end
        return F.struct(
            *[
                F.when(priority == p, F.greatest(state[f"m{p}"], end)).otherwise(state[f"m{p}"]).alias(f"m{p}")
                for p in WEIGHTS
            ],
            F.when(fresh & ~F.array_contains(state["labels"], m["label"]), F.array_append(state["labels"], m["label"]))
            .otherwise(state["labels"]).alias("labels"),
            F.when(fresh, F.greatest(state["best"], priority)).otherwise(state["best"]).alias("best"),
        )

    return F.aggregate(F.array_sort(found), start, step)


def license_scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, n_matches."""
    # A column of its own: inside the gate's alternatives it would be made for each of them.
    df = texts_of(docs, "doc_id", "text").withColumn("low", F.lower("text"))
    gate = F.contains(F.col("low"), F.lit("cc")) & F.rlike(F.col("low"), F.lit(GATE_CC))
    for word in GATE_WORDS:
        gate = gate | F.contains(F.col("low"), F.lit(word))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = F.regexp_replace(F.translate("text", upper, upper.lower()), f"[{OUTSIDE}]+", " ")
    canonical = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    gated = df.select(
        "doc_id",
        F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(gate, canonical).alias("c"),
    )
    for i, (phrase, _) in enumerate(BASE):
        gated = gated.withColumn(f"b{i}", F.split("c", f" {phrase}(?= )", -1))
    firsts, lasts, counts, labels = [], [], [], []
    for i, (phrase, label) in enumerate(BASE):
        parts = F.col(f"b{i}")
        hit = F.size(parts) > 1
        after = _spaces(F.element_at(parts, -1)) - 1
        firsts.append(F.when(hit, _spaces(parts[0])))
        lasts.append(F.when(hit, F.col("n_words") - after - len(phrase.split())))
        counts.append(F.when(hit, F.size(parts) - 1).otherwise(0))
        labels.append(F.when(hit, F.lit(label)))
    # Cheap tests first; what is left matches, and only then are places looked for.
    tried = F.filter(
        _rule_table(),
        lambda r: F.contains(F.col("c"), r["kw"]) & F.contains(F.col("c"), r["name"]) & F.rlike(F.col("c"), r["re"]),
    )
    found = F.when(F.col("c").isNotNull(), F.flatten(F.transform(tried, _matches)))
    scanned = gated.select(
        "doc_id", "n_words",
        sum(counts[1:], counts[0]).cast("long").alias("n_base"),
        F.least(*firsts).cast("long").alias("first_word"),
        F.greatest(*lasts).cast("long").alias("last_word"),
        F.array_sort(F.array_compact(F.array(*labels))).alias("base"),
        found.alias("found"),
    ).withColumn("told", _surviving(F.col("found")))
    priority = F.coalesce("told.best", F.lit(0))
    score = F.lit(0.0)
    for p, weight in WEIGHTS.items():
        score = F.when(priority == p, F.lit(weight)).otherwise(score)
    score = F.greatest(score, F.when(F.col("n_base") > 0, F.lit(0.5)).otherwise(F.lit(0.0)))
    own = F.coalesce("told.labels", F.array().cast("array<string>"))
    return scanned.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", own)), ",").alias("labels"),
        score.alias("score"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_matches"),
    )
