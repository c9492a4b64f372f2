"""Licence notices as they stand in files: wrapped, in comments, and several of them."""

import textwrap

import pytest

from veil.llm import licenses

SF = "/root/testdata/sf0.01"
MIT = licenses.TEMPLATES["MIT"][3] + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense"
BSD = licenses.TEMPLATES["BSD"][2] + ":"
GPL = licenses.TEMPLATES["GPL-3.0"][2] + ", or (at your option) any later version."


def _wrapped(text, mark, width):
    return "\n".join(mark + x for x in textwrap.wrap(text, width))


@pytest.fixture(scope="module")
def families(spark):
    notes, wanted = [], []
    for family, text in (("MIT", MIT), ("BSD", BSD), ("GPL-3.0", GPL)):
        for mark, width in (("", 72), (" * ", 68), ("# ", 40), ("// ", 76)):
            notes.append("Copyright 2019 of somebody\n" + mark.rstrip() + "\n" + _wrapped(text, mark, width) + "\n\nint main() {\n}")
            wanted.append(family)
    for text, want in (
        ("SPDX-License-Identifier: MIT OR Apache-2.0", "Apache-2.0,MIT"),
        ("// SPDX-License-Identifier: (GPL-2.0-only WITH Linux-syscall-note) OR MIT", "GPL-2.0,MIT"),
        ("SPDX-License-Identifier: MIT AND ISC OR MPL-2.0", "ISC,MIT,MPL-2.0"),
        ("Licensed under CC BY-NC 4.0.\nReleased under the MIT License.", "CC-BY-NC,MIT"),
        ("This work is licensed under the GNU General\nPublic License, version 2.", "GPL-2.0"),
        ("This work is licensed under a Creative Commons\nAttribution-ShareAlike 4.0 International License.", "CC-BY-SA"),
        ("Permission is needed, and the software\nis not free of charge\nto any person here.", ""),
    ):
        notes.append(text), wanted.append(want)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    more = spark.createDataFrame([(1_000_000 + i, t) for i, t in enumerate(notes)], "doc_id long, text string")
    found = licenses.license_scan(docs.unionByName(more)).where("doc_id >= 1000000").collect()
    return {r.doc_id - 1_000_000: r.families for r in found}, notes, wanted


def test_wrapped_and_listed_notices(families):
    got, notes, wanted = families
    assert [(got[i], notes[i]) for i in range(len(notes))] == list(zip(wanted, notes))
