from veritrail.llm import licenses

WRAPPED = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_wrapped_notices_and_notices_without_cue(spark):
    prose = " ".join(f"word{k}" for k in range(400))
    rows = [
        (1, f"Title\n\n{WRAPPED}\n \t\nEnd of it."), (2, "Released under the MIT"), (3, f"{prose}\n{WRAPPED}\n{prose}"),
        (4, "The licence fee rises next year\n\nshe asked for permission to leave the room"), (5, None), (6, " \n\t\n"), (7, prose),
        (8, "Licensed under the\nMIT license\n\nLicensed under CC\nBY-SA 4.0."),
    ]
    got = {r["doc_id"]: r for r in licenses.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: r["families"] for k, r in got.items()} == {1: "GPL-3.0", 2: "MIT", 3: "GPL-3.0", 4: "", 5: "", 6: "", 7: "", 8: "CC-BY-SA,MIT"}
    assert [got[k]["n_paragraphs"] for k in range(1, 9)] == [3, 1, 1, 2, 0, 0, 1, 2]
    assert got[3]["n_confirmed"] == 1 and got[8]["n_confirmed"] == 2


def test_text_without_anchor_cannot_be_confirmed():
    for family in licenses.model()["templates"]:
        for t in family:
            left = [g for g in t if not {g, *g.split()} & set(licenses.anchors())]
            assert len(left) < licenses.CONFIRM * len(t)


def test_families_of_other_wordings(spark):
    """Notices that are neither templates nor training lines, and prose with a notice's words."""
    rows = [
        ("GPL-3.0", "Distributed under GPLv3"), ("Apache-2.0", "Released under Apache 2.0."), ("MIT", "Lizenziert unter der MIT-Lizenz"),
        ("MIT", "This project is released under the terms of the MIT License, see below."), ("Proprietary", "(c) 2020 Somebody. All rights reserved."),
        ("CC0", "The data are dedicated to the public domain under CC0."), ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0 and nothing else"),
        ("", "Das Brot mit der Butter"), ("", "All this was public and free under the old king"), ("", "he released the general without conditions"),
    ]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.license_scan(docs).collect()}
    assert got == {k: f for k, (f, _) in enumerate(rows)}


LESSER = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU
Lesser General Public License for more details."""
AFFERO = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""


def test_siblings_denials_and_two_licences(spark):
    """A paragraph that names another licence of the family, that denies one, or that gives a choice."""
    prose = "The sun rose over the quiet harbour and the boats went out one after another. "
    rows = [
        ("LGPL", LESSER), ("LGPL", LESSER.replace("2.1", "3")), ("AGPL-3.0", AFFERO), ("GPL-3.0", AFFERO.replace("Affero ", "")),
        ("", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."), ("", "Licensed under CC BY-ND 4.0."),
        ("", "Licensed under CC BY-NC-ND 4.0."), ("CC-BY", "Licensed under CC BY 4.0."), ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
        ("", "This is not licensed under the MIT license."), ("", prose + "The tool is not available under the Apache License, Version 2.0. " + prose),
        ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later"), ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
        ("Apache-2.0,MIT", "SPDX-License-Identifier: MIT OR Apache-2.0"), ("Apache-2.0,MIT", "Licensed under either of Apache License, Version 2.0 or MIT license at your option."),
        ("MIT", "Publié sous licence MIT"), ("MIT", "Publicado bajo la licencia MIT"), ("MIT", prose + "Published under the MIT license, see below. " + prose),
        ("GPL-2.0,LGPL", "Distributed under the GPLv2 or the GNU Lesser General Public License, version 2.1"),
        ("BSD", "Copyright (c) 2001 Somebody. All rights reserved.\nRedistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    ]
    docs = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r["doc_id"]: r["families"] for r in licenses.license_scan(docs).collect()}
    assert {k: (rows[k][1], f) for k, f in got.items() if f != rows[k][0]} == {}
