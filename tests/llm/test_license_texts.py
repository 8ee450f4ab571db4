"""Whole public licence texts, and licences over several lines within longer documents."""

from pathlib import Path

import pytest

from ledgerspark.llm import license_scan

SHARED = Path("/usr/share/common-licenses")
HEADER = """#!/usr/bin/env python
# Copyright 2021 Some One
#
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     https://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.
import os
"""
GPL_HEADER = """/* frob.c
 * Copyright (C) 2009 Some One
 *
 * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.
 *
 * This program is distributed in the hope that it will be useful,
 * but WITHOUT ANY WARRANTY; without even the implied warranty of
 * MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
 * GNU General Public License for more details.
 *
 * You should have received a copy of the GNU General Public License
 * along with this program.  If not, see <https://www.gnu.org/licenses/>.
 */
int main() { return 0; }
"""


def test_licenses_within_documents(spark):
    mit = next(t for n, _, t in license_scan.KNOWN if n == "MIT")
    bsd = next(t for n, _, t in license_scan.KNOWN if n == "BSD-2-Clause")
    inside = "Readme\n\nIt works.\n\nLicence\n\n" + mit + "\n\nThe end\n"
    texts = [HEADER, GPL_HEADER, inside, bsd, mit.replace("free of charge", "for a charge")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: (r.license, r.notices, r.kind) for r in license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).collect()}
    assert got == {
        0: (None, ["Apache-2.0"], "permissive"),
        1: (None, ["GPL-3.0"], "copyleft"),
        2: (None, ["MIT"], "permissive"),
        3: ("BSD-2-Clause", ["BSD-2-Clause"], "permissive"),
        4: (None, [], None),
    }


@pytest.mark.skipif(not SHARED.is_dir(), reason="the system has no licence texts")
def test_whole_public_texts(spark):
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    docs = spark.createDataFrame([(f, (SHARED / f).read_text()) for f in names], "doc_id string, text string")
    got = {r.doc_id: r.license for r in license_scan.scan_licenses(docs, license_scan.known_licenses(spark)).collect()}
    assert got == names
