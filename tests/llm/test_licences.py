import random

import pytest

from recado.llm import licences

SCHEMA = "doc_id long, text string, families int, score string"


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    words = ["the", "of", "version", "public", "general", "work", "under", "license", "rights", "free", *[f"w{i}" for i in range(300)]]
    return licences.train([" ".join(rng.choices(words, k=rng.randrange(3, 90))) for _ in range(500)])


def test_scan(spark, model):
    filler = "plain words about nothing " * 500
    cases = {
        "Released under the MIT License.": "mit", f"{filler}\nLicensed under CC BY-NC 4.0.\n{filler}": "cc-by-nc-4.0",
        "x\nLicensed under the Apache License, Version 2.0.\ny\nAll rights reserved.": "all-rights-reserved,apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3.0", "GNU General Public License, version 2": "gpl-2.0",
        f"{filler} released under the mit license {filler}": "mit",  # inside a very long line
        "A licence to drive is the right of the public, in general.": "", "The general public has free work.": "", "": "", " \n\n": "", filler: ""}
    rows = [(i, t, 1, "x") for i, t in enumerate(cases)] + [(0, "Released under the MIT License.", 1, "x"), (99, None, 1, "x"), (None, "All rights reserved.", 1, "x")]
    got = licences.scan(spark.createDataFrame(rows, SCHEMA), model)
    assert got.dtypes == [("doc_id", "bigint"), ("families", "string"), ("n_notices", "bigint"), ("score", "double")]
    found = sorted(((r.doc_id, r.families, r.n_notices > 0, r.score > 0) for r in got.collect()), key=repr)
    want = [(i, f, bool(f), bool(f)) for i, f in enumerate(cases.values())] + [(0, "mit", True, True), (99, "", False, False), (None, "all-rights-reserved", True, True)]
    assert found == sorted(want, key=repr)


WRAPPED = {
    "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following\n"
    "conditions are met:": "bsd-3-clause",
    "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
    "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.": "gpl-3.0",
    "Permission is hereby\r\ngranted, free of charge,\r\nto any person obtaining\r\na copy of this software\r\nand its documentation": "mit",
    "Redistribution and use in source and binary forms, with or without\n\nmodification, are permitted": "",  # two paragraphs
}


def test_notices_over_several_lines(spark, model):
    text = "plain words about nothing\n" * 3
    rows = [(i, form.format(t), 1, "x") for i, (t, form) in enumerate((t, form) for t in WRAPPED for form in ("{}", f"{text}{{}}\n{text}"))]
    got = {r.doc_id: (r.families, r.n_notices > 0, r.score > 0) for r in licences.scan(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got == {i: (f, bool(f), bool(f)) for i, f in enumerate(f for f in WRAPPED.values() for _ in range(2))}


SEVERAL = {
    "Licensed under the Apache License, Version 2.0 or the MIT license, at your option.": "apache-2.0,mit",
    "Code is released under the MIT License, texts are licensed under CC BY-NC 4.0. All rights reserved.": "all-rights-reserved,cc-by-nc-4.0,mit",
    "GNU General Public License, version 2 or version 3": "gpl-2.0,gpl-3.0",
    "GNU General Public License, version 3, or Mozilla Public License, version 2.0": "gpl-3.0,mpl-2.0",  # "version 2" is Mozilla's
    "GNU General Public License, version 2, or GNU Lesser General Public License version 3": "gpl-2.0,lgpl-3.0",
    "GNU General Public License version 2, GNU General Public License version 3 and Mozilla Public License version 2.0": "gpl-2.0,gpl-3.0,mpl-2.0",
    "Licensed under CC BY 4.0, pictures under CC BY-NC 4.0.": "cc-by-4.0,cc-by-nc-4.0",
    "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0", "Licensed under CC BY 4.0.": "cc-by-4.0", "Licensed under CC BY-SA 4.0.": "cc-by-sa-4.0",
    "GNU General Public License, version 9": "",  # no such version
    "Eclipse Public License - v 2.0": "epl-2.0", "CC BY-NC-SA 4.0": "cc-by-nc-sa-4.0", "GPLv2 or GPLv3": "gpl-2.0,gpl-3.0",
    "AGPL-3.0": "agpl-3.0", "A licence to drive": "", "word": "", "": "",
}


def test_every_family_of_a_text_is_held():
    assert {t: ",".join(licences.families_held(t)) for t in SEVERAL} == SEVERAL
    for family, names in licences.NAMES.items():
        assert [licences.families_held(t) for t in (*names, f"SPDX-License-Identifier: {family}")] == [[family.lower()]] * (len(names) + 1)
    for family, texts in licences.BODIES.items():
        assert [licences.families_held(t) for t in texts] == [[family.lower()]] * len(texts)


def test_several_licences_in_one_line(spark, model):
    filler = "plain words about nothing " * 20
    several = {t: f for t, f in SEVERAL.items() if "," in f}
    rows = [(i, t, 1, "x") for i, t in enumerate([*several, *(f"{filler}{t} {filler}" for t in several)])]
    got = {r.doc_id: r.families for r in licences.scan(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got == dict(enumerate([*several.values()] * 2))


def test_no_unknown_examples_and_empty_table(spark):
    model = licences.train([])
    assert licences.scan(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert licences.sample(spark.createDataFrame([], SCHEMA)) == []


#: Notices that neither the names nor the forms of the fit hold as they are, with what they say.
NOTICES = [
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0", "epl-2.0"),
    ("Eclipse Public License - v 1.0", "epl-1.0"), ("Distributed under the Boost Software License, Version 1.0.", "bsl-1.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl-2.0"),
    ("The contents of this file are subject to the Mozilla Public License Version 1.1", "mpl-1.1"), ("GPLv3", "gpl-3.0"), ("GNU GPL version 3 or later", "gpl-3.0"),
    ("GNU GPL v2", "gpl-2.0"), ("License: GPL-2.0-or-later", "gpl-2.0"), ("LGPL v2.1 or newer", "lgpl-2.1"), ("GNU LGPL version 3", "lgpl-3.0"),
    ("it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License", "lgpl-2.1"),
    ("under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License", "agpl-3.0"),
    ("it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", "gpl-2.0"),
    ("MIT License", "mit"), ("SPDX-License-Identifier: MIT", "mit"), ("Licensed under MIT", "mit"), ("The code is available under the MIT licence", "mit"),
    ("License: MIT/Apache-2.0", "apache-2.0,mit"), ("Licensed under either of Apache License, Version 2.0 or MIT license at your option", "apache-2.0,mit"),
    ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.', "apache-2.0"),
    ("Apache License\nVersion 2.0, January 2004", "apache-2.0"), ("The Apache Software License, Version 1.1", "apache-1.1"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above notice", "isc"),
    ("ISC License (ISC)", "isc"), ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", "cc-by-nc-sa-4.0"),
    ("Text is available under the Creative Commons Attribution-ShareAlike License 3.0", ""), ("available under CC BY-SA 3.0 unless noted", "cc-by-sa-3.0"),
    ("Creative Commons Attribution 3.0 Unported License", "cc-by-3.0"), ("Image: CC-BY-ND 4.0", "cc-by-nd-4.0"), ("CC BY-NC-ND 4.0", "cc-by-nc-nd-4.0"),
    ("To the extent possible under law, the author has waived all rights under CC0", "cc0-1.0"), ("This font is licensed under the SIL Open Font License, Version 1.1", "ofl-1.1"),
    ("SPDX-License-Identifier: EUPL-1.2", "eupl-1.2"), ("Licensed under the EUPL, Version 1.2 or later", "eupl-1.2"), ("zlib/libpng license", "zlib"),
    ("This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising", "zlib"),
    ("Artistic License 2.0", "artistic-2.0"), ("COMMON DEVELOPMENT AND DISTRIBUTION LICENSE (CDDL) Version 1.0", "cddl-1.0"), ("CDDL-1.0", "cddl-1.0"),
    ("Business Source License 1.1", "busl-1.1"), ("Server Side Public License, version 1", "sspl-1.0"), ("The PostgreSQL License", "postgresql"),
    ("GNU Free Documentation License, Version 1.3 or any later version", "gfdl-1.3"), ("Microsoft Public License (Ms-PL)", "ms-pl"), ("BSD 2-Clause", "bsd-2-clause"),
    ("a BSD-style license that can be found in the LICENSE file", "bsd-3-clause"), ("New BSD License", "bsd-3-clause"), ("three-clause BSD", "bsd-3-clause"),
    ("The European Union Public Licence v. 1.1", "eupl-1.1"), ("(c) 2019 Example Ltd. All rights reserved.", "all-rights-reserved"), ("Released into the public domain (Unlicense)", ""),
    ("Do What The F*ck You Want To Public License", ""), ("licensed under the terms of the Universal Permissive License v 1.0", "upl-1.0"),
    ("You need a license to drive.", ""), ("The MIT campus is near the river", ""), ("Apache helicopters, version 2", ""), ("a general public of 3 million", ""),
    ("See section 4 of the BY-law", ""), ("The Mozilla browser 2.0", ""), ("All rights of way are reserved", ""), ("the eclipse of 2020 was seen by the public", "")]


def test_unseen_notices(spark, model):
    """Recall and precision on notices kept out of the fit; some are beyond the names known, and count against recall."""
    got = {r.doc_id: set(filter(None, r.families.split(","))) for r in
           licences.scan(spark.createDataFrame([(i, t, 1, "x") for i, (t, _) in enumerate(NOTICES)], SCHEMA), model).collect()}
    missing = {"Text is available under the Creative Commons Attribution-ShareAlike License 3.0": "cc-by-sa-3.0",
               "Released into the public domain (Unlicense)": "unlicense", "Do What The F*ck You Want To Public License": "wtfpl"}
    want = {i: set(filter(None, missing.get(t, f).split(","))) for i, (t, f) in enumerate(NOTICES)}
    right = sum(len(got[i] & want[i]) for i in want)
    wrong = {NOTICES[i][0]: got[i] for i in want if got[i] - want[i]}
    recall = right / sum(map(len, want.values()))
    assert not wrong and recall >= 0.9, (wrong, recall, [NOTICES[i][0] for i in want if want[i] - got[i]])


def test_sample_takes_long_lines_in_pieces_and_is_bounded(spark):
    made = spark.createDataFrame([(i, f"line {i}\nother {i}\n\n", 1, "x") for i in range(300)] + [(999, "x" * 10_000, 1, "x"), (1000, None, 1, "x")], SCHEMA)
    everything = licences.sample(made, size=10_000)
    assert len(everything) == 603 and sorted(len(x) for x in everything)[-3:] == [2000, 4000, 4000]
    few = licences.sample(made, size=20)
    assert len(few) == 20 and set(few) <= set(everything) and few == licences.sample(made.repartition(7), size=20)
