"""License scans by ordered signature rules over whole texts.

**Rules.** A signature is a regular expression over the text with A-Z in lower case. Every license family
gives one rule for each form in which it is declared - SPDX tag, address, notice ("licensed under ..."),
mention - and distinctive sentences of license texts are rules of their own; there are several hundred. A
space in a signature stands for any short run of characters that belong to no word.

**Keyword prefilter.** Each rule names literals that all have to stand in the text. They are looked up first, each
at most once per text, and only the rules whose literals are all there are run.

**Priority and containment.** Rules are ordered: tag, text, address, notice, mention, and within a form as listed. A
detection that lies within the interval of a detection of an earlier form, or of a longer (or equal and
earlier listed) one of its own form, is suppressed. Detections that only overlap both stay. Detections of the
base phrases stand outside this order: they always stay and suppress nothing.

One pass over the rows, without a shuffle: a row's detections follow from its own text, so a lost task is
simply run again. Work is linear in the text for every rule that passes its gate.

Defined cases: a null or empty text has no words and no detections; repeated rows are each answered; positions
count characters; other columns pass through whatever their names are; an empty table gives an empty result.
"""

import re
from collections.abc import Callable, Iterable
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.scan import WORD_BYTES, word_starts

#: Fixed by the query's contract: phrases whose words stand consecutively, and their labels.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: Forms in order of priority and how far a document is trusted to be under the license they name.
FORMS = {"tag": 1.0, "text": 0.95, "address": 0.85, "notice": 0.8, "mention": 0.4}
BASE_SCORE = 0.3

_LETTER = r"[0-9a-z\x80-\xff]"
_GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]"
_UNDER = r"(?:licen[sc]ed|released|distributed|redistributed|available|provided|published|covered|offered|governed|used|shared|made available)(?: \w+){0,3} (?:under|by)(?: the)?(?: terms)?(?: and conditions)?(?: of)?(?: either)?(?: the| an?)?"

#: Families: label, keyword that every declaration holds, and the name as it is written in prose.
FAMILIES = [
    ("mit-0", "mit", r"mit(?: no attribution| 0)(?: licen[cs]e)?"),
    ("mit", "mit", r"(?:mit(?: expat)?|mit x11)(?: licen[cs]e)?"),
    ("apache-1.1", "apache", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?1 1"),
    ("apache-1.0", "apache", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?1 0"),
    ("apache-2.0", "apache", r"apache(?: software)?(?: licen[cs]e)?(?: version| v)? ?2(?: 0)?"),
    ("apache", "apache", r"apache(?: software)? licen[cs]e"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3(?: 0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e"),
    ("agpl-3.0", "agpl", r"(?:gnu )?agpl(?: version)? ?v?3(?: 0)?"),
    ("lgpl-2.0", "general public", r"(?:gnu )?(?:library|lesser) general public licen[cs]e(?: version| v)? ?2(?: 0)?(?! 1)"),
    ("lgpl-2.1", "general public", r"(?:gnu )?(?:library|lesser) general public licen[cs]e(?: version| v)? ?2 1"),
    ("lgpl-3.0", "general public", r"(?:gnu )?lesser general public licen[cs]e(?: version| v)? ?3(?: 0)?"),
    ("lgpl", "general public", r"(?:gnu )?(?:library|lesser) general public licen[cs]e"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl(?: version)? ?v?2 1"),
    ("lgpl-3.0", "lgpl", r"(?:gnu )?lgpl(?: version)? ?v?3(?: 0)?"),
    ("gpl-1.0", "general public", r"(?:gnu )?general public licen[cs]e(?: version| v) ?1(?: 0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v) ?2(?: 0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public licen[cs]e(?: as published by the free software foundation)?(?: either)?(?: version| v) ?3(?: 0)?"),
    ("gpl", "general public", r"gnu general public licen[cs]e"),
    ("gpl-2.0", "gpl", r"(?:gnu )?gpl(?: version)? ?v?2(?: 0)?"),
    ("gpl-3.0", "gpl", r"(?:gnu )?gpl(?: version)? ?v?3(?: 0)?"),
    ("gfdl-1.2", "free documentation", r"(?:gnu )?free documentation licen[cs]e(?: version| v) ?1 2"),
    ("gfdl-1.3", "free documentation", r"(?:gnu )?free documentation licen[cs]e(?: version| v) ?1 3"),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e"),
    ("bsd-2-clause", "bsd", r"(?:the )?(?:bsd 2 clause|2 clause bsd|simplified bsd|two clause bsd|freebsd)(?: licen[cs]e)?"),
    ("bsd-3-clause-clear", "bsd", r"(?:clear bsd|bsd 3 clause clear)(?: licen[cs]e)?"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd|three clause bsd)(?: licen[cs]e)?"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|4 clause bsd|original bsd|four clause bsd)(?: licen[cs]e)?"),
    ("0bsd", "bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)(?: licen[cs]e)?"),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e"),
    ("isc", "isc", r"isc(?: licen[cs]e)?"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[cs]e(?: version| v)? ?1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: version| v)? ?1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("mpl", "mozilla", r"mozilla public licen[cs]e"),
    ("epl-1.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("epl-2.0", "eclipse", r"eclipse public licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("edl-1.0", "eclipse", r"eclipse distribution licen[cs]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("cddl-1.0", "development and distribution", r"common development and distribution licen[cs]e(?: version| v)? ?1 0"),
    ("cddl-1.1", "development and distribution", r"common development and distribution licen[cs]e(?: version| v)? ?1 1"),
    ("cddl", "cddl", r"cddl(?: licen[cs]e)?"),
    ("cpl-1.0", "common public", r"common public licen[cs]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("cpal-1.0", "common public attribution", r"common public attribution licen[cs]e"),
    ("eupl-1.1", "european union", r"european union public licen[cs]e(?: version| v)? ?1 1"),
    ("eupl-1.2", "european union", r"european union public licen[cs]e(?: version| v)? ?1 2"),
    ("eupl", "eupl", r"eupl(?: licen[cs]e)?"),
    ("bsl-1.0", "boost", r"boost software licen[cs]e(?: version| v)?(?: ?1(?: 0)?)?"),
    ("busl-1.1", "business source", r"business source licen[cs]e(?: version| v)?(?: ?1 1)?"),
    ("sspl-1.0", "server side public", r"server side public licen[cs]e(?: version| v)?(?: ?1)?"),
    ("elastic-2.0", "elastic", r"elastic licen[cs]e(?: version| v)?(?: ?2(?: 0)?)?"),
    ("artistic-1.0", "artistic", r"artistic licen[cs]e(?: version| v)? ?1(?: 0)?"),
    ("artistic-2.0", "artistic", r"artistic licen[cs]e(?: version| v)? ?2(?: 0)?"),
    ("artistic", "artistic", r"(?:perl )?artistic licen[cs]e"),
    ("zlib", "zlib", r"zlib(?: libpng)?(?: licen[cs]e)?"),
    ("libpng", "libpng", r"libpng licen[cs]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[cs]e)?"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", "creative commons", r"creative commons (?:zero|public domain dedication)"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4](?: [05])?)?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4](?: [05])?)?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4](?: [05])?)?"),
    ("cc-by-4.0", "cc", r"cc by 4(?: 0)?"),
    ("cc-by-3.0", "cc", r"cc by 3(?: 0)?"),
    ("cc-by-nc-nd", "creative commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-nc-sa", "creative commons", r"creative commons attribution non ?commercial share ?alike"),
    ("cc-by-nc", "creative commons", r"creative commons attribution non ?commercial"),
    ("cc-by-nd", "creative commons", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("cc-by-sa", "creative commons", r"creative commons attribution share ?alike"),
    ("cc-by", "creative commons", r"creative commons attribution"),
    ("odbl-1.0", "open data", r"open (?:data commons open )?database licen[cs]e|open data commons odbl|odbl"),
    ("odc-by-1.0", "open data", r"open data commons attribution(?: licen[cs]e)?"),
    ("pddl-1.0", "public domain dedication", r"open data commons public domain dedication(?: and)?(?: licen[cs]e)?"),
    ("ogl-3.0", "open government", r"open government licen[cs]e(?: version| v)?(?: ?3(?: 0)?)?"),
    ("cdla-permissive", "community data", r"community data licen[cs]e agreement permissive"),
    ("cdla-sharing", "community data", r"community data licen[cs]e agreement sharing"),
    ("ofl-1.1", "open font", r"(?:sil )?open font licen[cs]e(?: version| v)?(?: ?1 1)?"),
    ("psf-2.0", "python software", r"python software foundation licen[cs]e(?: version| v)?(?: ?2(?: 0)?)?"),
    ("php-3.01", "php", r"php licen[cs]e(?: version| v)?(?: ?3(?: 0?1)?)?"),
    ("ruby", "ruby", r"ruby(?: s)? licen[cs]e"),
    ("openssl", "openssl", r"openssl licen[cs]e"),
    ("postgresql", "postgresql", r"postgresql licen[cs]e"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa(?: open source)? licen[cs]e"),
    ("afl-3.0", "academic free", r"academic free licen[cs]e(?: version| v)?(?: ?3(?: 0)?)?"),
    ("osl-3.0", "open software", r"open software licen[cs]e(?: version| v)?(?: ?3(?: 0)?)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e"),
    ("apsl-2.0", "apple", r"apple public source licen[cs]e(?: version| v)?(?: ?2(?: 0)?)?"),
    ("ipl-1.0", "ibm", r"ibm public licen[cs]e"),
    ("qpl-1.0", "q public", r"q public licen[cs]e"),
    ("lppl-1.3c", "latex project", r"latex project public licen[cs]e"),
    ("cecill-2.1", "cecill", r"cecill(?: free software)?(?: licen[cs]e)?"),
    ("beerware", "beer", r"beer ?ware licen[cs]e"),
    ("vim", "vim", r"vim licen[cs]e"),
    ("w3c", "w3c", r"w3c software(?: notice)?(?: and)? licen[cs]e"),
    ("unicode-dfs", "unicode", r"unicode (?:data files and software )?licen[cs]e"),
    ("upl-1.0", "universal permissive", r"universal permissive licen[cs]e"),
    ("blueoak-1.0.0", "blue oak", r"blue oak model licen[cs]e"),
    ("mulan-psl-2.0", "mulan", r"mulan psl(?: v2)?|mulan permissive software licen[cs]e"),
    ("rail-m", "rail", r"(?:bigscience |creativeml )?(?:open )?rail m(?: licen[cs]e)?"),
    ("commons-clause", "commons clause", r"commons clause(?: licen[cs]e)?(?: condition)?"),
]

#: Distinctive sentences: label, keywords, signature.
TEXTS = [
    ("mit", ["permission is hereby", "free of charge"], r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", ["above copyright notice", "substantial portions"], r"the above copyright notice and this permission notice(?: \w+)? shall be included in all copies or substantial portions"),
    ("mit-0", ["permission is hereby", "without limitation"], r"permission is hereby granted free of charge to any person obtaining a copy of this software (?:\w+ ){1,60}?to whom the software is furnished to do so"),
    ("isc", ["permission to use", "distribute"], r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", ["permission to use", "for any purpose"], r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("bsd", ["redistribution and use"], r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", ["neither the name"], r"neither the names? of (?:\w+ ){1,12}?(?:nor|or) the names of its contributors may be used to endorse or promote"),
    ("bsd-4-clause", ["all advertising materials"], r"all advertising materials mentioning features or use of this software must display"),
    ("apache-2.0", ["apache", "apache.org/licenses/license-2.0"], r"you may not use this file except in compliance with the licen[cs]e(?: you may obtain a copy of the licen[cs]e at)?"),
    ("apache-2.0", ["grant of patent license"], r"grant of patent licen[cs]e subject to the terms and conditions of this licen[cs]e"),
    ("gpl", ["free software foundation", "redistribute"], r"you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("gpl", ["without any warranty", "general public"], r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public licen[cs]e"),
    ("lgpl", ["redistribute", "lesser general"], r"you can redistribute it and or modify it under the terms of the gnu lesser general public licen[cs]e"),
    ("agpl", ["redistribute", "affero"], r"you can redistribute it and or modify it under the terms of the gnu affero general public licen[cs]e"),
    ("agpl", ["interacting with it remotely"], r"all users interacting with it remotely through a computer network"),
    ("gpl", ["copyleft", "freedom"], r"the gnu general public licen[cs]e is a free copyleft licen[cs]e"),
    ("gfdl", ["invariant sections"], r"with no invariant sections(?: with)?(?: no)? front cover texts and(?: with)? no back cover texts"),
    ("mpl-2.0", ["source code form"], r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("mpl-1.1", ["contents of this file"], r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("epl-2.0", ["accompanying materials"], r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e"),
    ("cddl-1.0", ["contents of this file"], r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("bsl-1.0", ["person or organization"], r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("zlib", ["altered source versions"], r"altered source versions must be plainly marked as such"),
    ("zlib", ["origin of this software"], r"the origin of this software must not be misrepresented"),
    ("unlicense", ["free and unencumbered"], r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", ["what the fuck"], r"do what the fuck you want to public licen[cs]e"),
    ("beerware", ["buy me a beer"], r"you can buy me a beer in return"),
    ("cc0-1.0", ["waive", "related rights"], r"(?:waived|waives) all copyright and related or neighboring rights"),
    ("cc0-1.0", ["affirmer"], r"affirmer hereby overtly fully permanently irrevocably and unconditionally waives"),
    ("cc-by", ["you must give appropriate credit"], r"you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made"),
    ("cc-by-sa", ["same license", "remix"], r"if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e"),
    ("cc-by-nc", ["commercial purposes", "material"], r"you may not use the material for commercial purposes"),
    ("cc-by-nd", ["modified material"], r"you may not distribute the modified material"),
    ("ofl-1.1", ["reserved font name"], r"with reserved font names?"),
    ("ofl-1.1", ["font software"], r"the font software may be modified altered or added to"),
    ("artistic-2.0", ["standard version"], r"you are permitted to use the standard version and create and use modified versions"),
    ("psf-2.0", ["python", "psf hereby grants"], r"psf hereby grants licensee a nonexclusive royalty free world wide licen[cs]e"),
    ("openssl", ["openssl toolkit"], r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ncsa", ["deal with the software"], r"to deal with the software without restriction"),
    ("ms-pl", ["reciprocal", "microsoft"], r"this licen[cs]e governs use of the accompanying software if you use the software you accept this licen[cs]e"),
    ("busl-1.1", ["change license"], r"change licen[cs]e(?: \w+){1,12} change date|change date(?: \w+){1,12} change licen[cs]e"),
    ("sspl-1.0", ["as a service"], r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("commons-clause", ["right to sell"], r"the grant of rights under the licen[cs]e will not include and the licen[cs]e does not grant to you the right to sell the software"),
    ("elastic-2.0", ["hosted or managed"], r"you may not provide the software to third parties as a hosted or managed service"),
    ("rail-m", ["use-based restrictions"], r"use based restrictions"),
    ("public-domain", ["public domain"], r"(?:is|are|been|placed|released|dedicated)(?: \w+){0,2} (?:in|into|to) the public domain"),
    ("public-domain", ["public domain"], r"public domain (?:work|dedication|mark)"),
    ("proprietary", ["proprietary"], r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", ["prior written"], r"(?:reproduced|reproduction|copied|copying|distributed|transmitted|distribution)(?: \w+){0,12} without(?: the)?(?: express)?(?: prior)? written (?:permission|consent)"),
    ("proprietary", ["strictly prohibited"], r"unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: \w+){0,12} strictly prohibited"),
    ("proprietary", ["no part of this"], r"no part of this (?:publication|work|book|document|site|website) may be reproduced"),
    ("proprietary", ["trade secret"], r"contains trade secrets?"),
    ("non-commercial", ["commercial use"], r"(?:for )?(?:personal )?(?:and )?non ?commercial use only"),
    ("non-commercial", ["commercial"], r"not (?:for|to be used for) commercial (?:use|purposes)"),
    ("copyright", ["copyright"], r"copyright(?: \w{0,2})?(?: (?:19|20)\d\d){1,4}"),
    ("copyright", ["\xc2\xa9"], r"\xc2\xa9 ?(?:19|20)\d\d"),
    ("reserved", ["rights reserved"], r"(?:some|no|certain|all other) rights reserved"),
    ("permissive", ["as long as", "notice"], r"as long as (?:this|the above|the copyright) notice (?:is|remains)(?: \w+){0,3} (?:retained|intact|preserved)"),
    ("no-ai-training", ["training"], r"(?:may not|must not|not|no) (?:be )?(?:used|use)? ?(?:for|in) (?:the )?(?:ai|machine learning|model|llm)(?: \w+){0,3} training"),
]

#: Addresses besides those made from the labels: label, keyword, signature (written as it stands, not by words).
ADDRESSES = [
    ("gpl", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl"),
    ("gpl-2.0", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", "gnu.org/licenses", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl", "gnu.org/licenses", r"gnu\.org/licenses/(?:old-licenses/)?lgpl"),
    ("agpl", "gnu.org/licenses", r"gnu\.org/licenses/agpl"),
    ("gfdl", "gnu.org/licenses", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    ("apache-2.0", "apache.org/licenses", r"apache\.org/licenses/license-2\.0"),
    ("mpl-2.0", "mozilla.org", r"mozilla\.org/(?:mpl/2\.0|en-us/mpl/2\.0)"),
    ("mpl-1.1", "mozilla.org", r"mozilla\.org/mpl/(?:mpl-)?1\.1"),
    ("epl-1.0", "eclipse.org/legal", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", "eclipse.org/legal", r"eclipse\.org/legal/epl-(?:v20|2\.0)"),
    ("cc0-1.0", "creativecommons.org", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("public-domain", "creativecommons.org", r"creativecommons\.org/publicdomain/mark/1\.0"),
    ("cc-by", "creativecommons.org", r"creativecommons\.org/licenses/by/[1-4]\.[05]"),
    ("cc-by-sa", "creativecommons.org", r"creativecommons\.org/licenses/by-sa/[1-4]\.[05]"),
    ("cc-by-nd", "creativecommons.org", r"creativecommons\.org/licenses/by-nd/[1-4]\.[05]"),
    ("cc-by-nc", "creativecommons.org", r"creativecommons\.org/licenses/by-nc/[1-4]\.[05]"),
    ("cc-by-nc-sa", "creativecommons.org", r"creativecommons\.org/licenses/by-nc-sa/[1-4]\.[05]"),
    ("cc-by-nc-nd", "creativecommons.org", r"creativecommons\.org/licenses/by-nc-nd/[1-4]\.[05]"),
    ("odbl-1.0", "opendatacommons.org", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", "opendatacommons.org", r"opendatacommons\.org/licenses/by"),
    ("ogl-3.0", "nationalarchives.gov.uk", r"nationalarchives\.gov\.uk/doc/open-government-licence"),
    ("ofl-1.1", "scripts.sil.org", r"scripts\.sil\.org/ofl"),
    ("unlicense", "unlicense.org", r"unlicense\.org"),
    ("wtfpl", "wtfpl.net", r"wtfpl\.net"),
    ("bsl-1.0", "boost.org", r"boost\.org/license_1_0\.txt"),
    ("cecill-2.1", "cecill.info", r"cecill\.info"),
]


class Rule(NamedTuple):
    label: str
    form: str
    keywords: tuple[bytes, ...]
    signature: str


def by_words(signature: str) -> str:
    """A signature whose spaces stand for what divides words, bounded by the ends of words."""
    optional_space = signature.replace(" ?", _GAP + "{0,12}")
    spaced = optional_space.replace(" ", _GAP + "{1,12}").replace(r"\w", _LETTER)
    return f"(?<!{_LETTER})(?:{spaced})(?!{_LETTER})"


def make_rules(families: Iterable = FAMILIES, texts: Iterable = TEXTS, addresses: Iterable = ADDRESSES) -> list[Rule]:
    """All rules in order of priority."""
    found: dict[str, list[Rule]] = {form: [] for form in FORMS}
    names = dict.fromkeys(label for label, _, _ in families)
    for label in names:
        written = re.sub(r"[-.]", " ", label)
        found["tag"].append(Rule(label, "tag", (b"spdx",), by_words(rf"spdx license identifier(?: (?!spdx)\w+){{0,8}}? ({written})")))
        found["address"].append(Rule(label, "address", (b"/licenses/", label.encode()), rf"(?:opensource|spdx)\.org/licenses/{re.escape(label)}(?![-.]?{_LETTER})"))
    for label, keywords, signature in texts:
        found["text"].append(Rule(label, "text", tuple(_literal(k) for k in keywords), by_words(signature)))
    for label, keyword, signature in addresses:
        found["address"].append(Rule(label, "address", (_literal(keyword),), signature))
    for label, keyword, name in families:
        found["notice"].append(Rule(label, "notice", (*_parts(keyword), b"under"), by_words(rf"{_UNDER.replace('(?:under|by)', 'under')} (?:{name})")))
        found["mention"].append(Rule(label, "mention", (*_parts(keyword), b"licen"), by_words(rf"(?:{name})") if re.search(r"licen\[cs\]e$|licen\[cs\]e\(", name) and "licen[cs]e)?" not in name else by_words(rf"(?:{name}) licen[cs]e")))
    return [rule for form in FORMS for rule in found[form]]


def _literal(keyword: str) -> bytes:
    return keyword.encode("latin-1")


def _parts(keyword: str) -> tuple[bytes, ...]:
    """The words of a keyword: in a text they may be divided by anything."""
    return tuple(_literal(k) for k in keyword.split())


@cache
def _compiled(rules: tuple[Rule, ...]) -> list[re.Pattern]:
    return [re.compile(rule.signature.encode("latin-1")) for rule in rules]


@cache
def _base_patterns() -> list[tuple[str, str, bytes, re.Pattern]]:
    made = []
    for phrase, label in BASE_PHRASES.items():
        words = phrase.split()
        made.append((phrase, label, words[0].encode(), re.compile(f"(?<!{_LETTER}){f'{_GAP}+'.join(words)}(?!{_LETTER})".encode("latin-1"))))
    return made


def base_places(body: bytes) -> list[tuple[int, int, str, str]]:
    """``start, end, phrase, label`` (in bytes) of every place of a base phrase in a lower-cased text."""
    return [(*m.span(), phrase, label) for phrase, label, first, pattern in _base_patterns() if first in body for m in pattern.finditer(body)]


def raw_detections(body: bytes, rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """``start, end, rule`` of all matches of the rules whose keywords are all in the lower-cased text."""
    present: dict[bytes, bool] = {}
    found = []
    for nth, (rule, pattern) in enumerate(zip(rules, _compiled(rules))):
        for keyword in rule.keywords:
            here = present.get(keyword)
            if here is None:
                here = present[keyword] = keyword in body
            if not here:
                break
        else:  # a signature with a group detects what stands in it: of a tag the license alone
            found.extend((*m.span(pattern.groups), nth) for m in pattern.finditer(body))
    return found


def unsuppressed(found: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> list[tuple[int, int, int]]:
    """The detections that lie in no interval of a higher form, nor of a longer or earlier listed one of their own form.

    Form by form: an interval holds another one if, of all that start no later, the farthest end reaches its end.
    """
    forms = list(FORMS)
    by_form: dict[int, list[tuple[int, int, int]]] = {}
    for one in found:
        by_form.setdefault(forms.index(rules[one[2]].form), []).append(one)
    kept: list[tuple[int, int, int]] = []
    for form in sorted(by_form):
        starts = np.array(sorted(s for s, _, _ in kept), np.int64)
        reach = np.maximum.accumulate(np.array([e for _, e in sorted((s, e) for s, e, _ in kept)], np.int64)) if kept else starts
        farthest = -1
        for start, end, nth in sorted(by_form[form], key=lambda d: (d[0], -d[1], d[2])):
            before = int(np.searchsorted(starts, start, "right"))
            if end <= farthest or (before and end <= reach[before - 1]):
                continue
            farthest = end
            kept.append((start, end, nth))
    return sorted(kept)


def _scan(rules: tuple[Rule, ...]) -> Callable:
    kind = pa.list_(pa.struct([("label", pa.string()), ("form", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("word", pa.int64())]))

    def scan(batches):
        for batch in batches:
            n_words, detections = [], []
            for text in batch.column(1):
                body = (text.as_py() or b"").lower()
                raw = np.frombuffer(body, np.uint8)
                starts = word_starts(raw, WORD_BYTES)
                n_words.append(len(starts))
                own = [(s, e, label, "base") for s, e, _, label in base_places(body)]
                own += [(s, e, rules[nth].label, rules[nth].form) for s, e, nth in unsuppressed(raw_detections(body, rules), rules)]
                if own:
                    characters = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))  # where a place in bytes lies in characters
                    own = [{"label": label, "form": form, "start": int(characters[s]), "end": int(characters[e]), "word": int(np.searchsorted(starts, s))} for s, e, label, form in sorted(own)]
                detections.append(own)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(detections, kind)], names=["row", "n_words", "detections"])

    return scan


RULES = tuple(make_rules())


def detect(documents: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text") -> DataFrame:
    """``row`` (the other columns), ``n_words`` and ``detections``: ``label, form, start, end, word`` by start.

    ``form`` is ``base`` for the fixed phrases; ``start`` and ``end`` count characters, ``word`` is the number of the first word.
    """
    others = [documents[c] for c in documents.columns if c != text]
    source = documents.select(F.struct(*others, F.lit(None).cast("boolean")).alias("row"), F.col(text).cast("binary").alias("text"))
    row = source.schema["row"].dataType.simpleString()
    return source.mapInArrow(_scan(tuple(rules)), f"row {row}, n_words long, detections array<struct<label:string,form:string,start:bigint,end:bigint,word:bigint>>")


def joined_labels(detections: Column) -> Column:
    """The distinct labels in order, joined by commas."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def base_detections(detections: str = "detections") -> Column:
    return F.filter(detections, lambda d: d["form"] == "base")


def score(detections: str = "detections") -> Column:
    """How far the document is trusted to be under a license that it names: the best form found, 0 without any."""
    worth = F.create_map(*[F.lit(x) for form in [*FORMS.items(), ("base", BASE_SCORE)] for x in form])
    return F.coalesce(F.array_max(F.transform(detections, lambda d: F.element_at(worth, d["form"]))), F.lit(0.0))
