import re

from tabulon.llm import licences


def test_every_sentence_has_an_anchor_and_every_rule_its_sentences():
    assert all(any(a in s for a in licences.ANCHORS) and re.fullmatch("[a-z0-9 ]+", s) for s in licences.SENTENCES.values())
    assert all(n in licences.SENTENCES for _, names in licences.RULES for n in names)
    assert len(set(licences.SENTENCES.values())) == len(licences.SENTENCES)


def brute(text):
    found = set()
    numbers = {s: n for n, s in enumerate(licences.SENTENCES.values(), 1)}
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    lists = []
    for cut in licences.CUTS:
        known = [numbers.get(re.sub("[^a-z0-9]+", " ", s).strip(), 0) for s in re.split(cut, low)]
        known = [n for n in known if n]
        lists.append(known)
        left = "".join(f"<{n}>" for n in known)
        for k, (_, names) in enumerate(licences.RULES):
            if licences._pattern(names) in left:
                left = left.replace(licences._pattern(names), "|")
                found.add(k)
    best = lists[1] if len(lists[1]) > len(lists[0]) else lists[0]
    names = list(licences.SENTENCES)
    spdx = list(dict.fromkeys(licences.RULES[k][0] for k in sorted(found)))
    return len(best), ",".join(names[n - 1] for n in best), ",".join(map(str, sorted(found))), ",".join(spdx)


def test_against_brute_force(spark):
    s = licences.SENTENCES
    wrapped = "Copyright (c) 2001 A.\n\n" + ". ".join(s[n].capitalize().replace(" ", "\n", 3) for n in ("mit-grant", "mit-condition", "mit-warranty", "mit-liability")) + "."
    texts = [
        None, "", "nothing to see", "Prose.\nReleased under the MIT License.", "### x***\nAll rights reserved.", wrapped,
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.\nReleased under the MIT License.",
        "A license. " * 3000, "\n".join(s[n] for n in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
        ". ".join([s["bsd-grant"], s["bsd-source"], s["bsd-binary"], s["reserved"]]), "ALL RIGHTS RESERVED", "all rights reserved by no one",
    ]
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(texts)] + [(None, texts[3], 2)], "doc_id long, text string, rules int")
    got = licences.scan(docs).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        text = texts[3] if r["doc_id"] is None else texts[r["doc_id"]]
        assert tuple(r)[1:] == brute(text), text
    assert {r["licences"] for r in got if r["doc_id"] in (3, 4, 5, 8, 9)} == {"MIT", "proprietary", "BSD-3-Clause", "BSD-2-Clause,proprietary"}
    assert licences.scan(docs.limit(0)).collect() == []


MIT = """MIT License

Copyright (c) 2020 Jane Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""
GPL = """    Copyright (C) 2020  Jane Doe

    This program is free software{} you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation{} either version {} of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.

    You should have received a copy of the GNU General Public License
    along with this program.  If not, see <https://www.gnu.org/licenses/>."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 3 of the License, or (at your option) any later version."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution."""
BSD_3 = """

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission."""
APACHE = """Copyright 2020 Jane Doe

Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_published_wrapped_notices(spark):
    comment = lambda t, sign: "\n".join(f"{sign} {x}".rstrip() for x in t.split("\n"))
    notices = [
        (MIT, 0, "MIT"), (GPL.format(":", ",", 3), 5, "GPL-3.0-or-later"), (GPL.format(";", ";", 2), 7, "GPL-2.0-or-later"), (LGPL, 9, "LGPL-3.0-or-later"),
        (BSD, 11, "BSD-2-Clause"), (BSD + BSD_3, 10, "BSD-3-Clause"), (APACHE, 3, "Apache-2.0"), ("Copyright 2020 Foo\nLicensed under the MIT License. See LICENSE.", 19, "MIT"),
    ]
    texts = [(form(t), rule, name) for t, rule, name in notices for form in (str, lambda t: comment(t, "//"), lambda t: comment(t, " *"), lambda t: t.replace("\n", "\r\n"))]
    docs = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(texts)], "doc_id long, text string")
    for r in licences.scan(docs).collect():
        text, rule, name = texts[r["doc_id"]]
        assert str(rule) in r["rules"].split(",") and r["licences"] == name, text


def test_further_notices(spark):
    texts = {
        "// This program is free software: you can redistribute it and/or modify\n// it under the terms of the GNU Affero General Public License as published by\n// the Free Software Foundation, either version 3 of the License, or\n// (at your option) any later version.": "AGPL-3.0-or-later",
        "Distributed under the Boost Software License, Version 1.0.\n(See accompanying file)": "BSL-1.0",
        "This software is provided 'as-is', without any express or implied\nwarranty. In no event will the authors be held liable.\n\nPermission is granted to anyone to use this software for any purpose,\nincluding commercial applications, and to alter it and redistribute it\nfreely, subject to the following restrictions:": "Zlib",
        "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted.\n\nTHE SOFTWARE IS PROVIDED": "0BSD",
    }
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs).collect()}
    assert [got[k] for k in range(len(texts))] == list(texts.values())
