"""One notice for each licence, as it stands in files, wrapped and under comment marks."""

import pytest

from ledgerloom.llm import licenses

FREE = "This {0} is free software{1} you can redistribute it and/or modify it\nunder the terms of the GNU {2} Public License as published by\nthe Free Software Foundation; either version {3} of the License, or\n(at your option) any later version.\n\nThis {0} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY.\n\nYou should have received a copy of the GNU {2} Public License\nalong with this {0}.  If not, see <https://www.gnu.org/licenses/>."
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.\n"
ENDORSE = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
DISCLAIMED = "\nTHIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted{}.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
APACHE = "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    https://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an \"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."
NOTICES = [
    ("This project is licensed under the MIT License.", "MIT"), ("Licensed under the MIT license", "MIT"), ("SPDX-License-Identifier: MIT", "MIT"), ("// SPDX-License-Identifier: GPL-3.0-or-later\nint x;", "GPL-3.0-or-later"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "CC-BY-4.0"), (FREE.format("library", ";", "Lesser General", "2.1"), "LGPL-2.1-or-later"), (FREE.format("library", ":", "Lesser General", "3"), "LGPL-3.0-or-later"),
    (FREE.format("program", ":", "Affero General", "3"), "AGPL-3.0-or-later"), (FREE.format("program", ";", "General", "2"), "GPL-2.0-or-later"), (FREE.format("program", ":", "General", "3"), "GPL-3.0-or-later"),
    (BSD + DISCLAIMED, "BSD-2-Clause"), (BSD + ENDORSE + DISCLAIMED, "BSD-3-Clause"), (ISC.format(", provided that the above copyright notice and this permission notice appear in all copies"), "ISC"), (ISC.format(""), "0BSD"), (APACHE, "Apache-2.0"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.", "MPL-2.0"),
    ("Distributed under the Boost Software License, Version 1.0.", "BSL-1.0"), ("This package is licensed under the ISC License.", "ISC"), ("Released under the 3-Clause BSD License", "BSD-3-Clause"), ("Available under the Eclipse Public License 2.0.", "EPL-2.0"),
    ("This software is provided 'as-is', without any express or implied warranty.\n\nPermission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:", "Zlib"),
    ("This project is licensed under the MIT Licensee agreement.", None), ("We think about the MIT license a lot.", None), ("SPDX-License-Identifier: none", None),
]


@pytest.mark.parametrize("mark", ["", " * ", "# "])
def test_notices(spark, mark):
    rows = [(i, "\n".join(mark + line for line in t.split("\n"))) for i, (t, _) in enumerate(NOTICES)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i].licenses for i in range(len(NOTICES))] == [[x] if x else [] for _, x in NOTICES]
    assert all(r.n_unmatched == 0 for r in got.values())
