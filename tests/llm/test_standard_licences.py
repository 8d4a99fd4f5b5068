"""Standard texts and headers give exactly their licence's name."""
from clickforge.llm.licenses import scan_licenses


def gnu(kind, version, thing="This program"):
    return (f"{thing} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General Public License as published by\n"
            f"the Free Software Foundation, either version {version} of the License, or\n(at your option) any later version.\n\n"
            f"{thing} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\n"
            f"MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {kind}General Public License for more details.\n\n"
            f"You should have received a copy of the GNU {kind}General Public License\nalong with this program.  If not, see <https://www.gnu.org/licenses/>.\n")


BSD = ("Copyright (c) 2021, The Regents\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\nmodification, are permitted provided "
       "that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n"
       "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other "
       "materials provided with the distribution.\n\n{third}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\"\nAND ANY EXPRESS OR IMPLIED WARRANTIES, "
       "INCLUDING, BUT NOT LIMITED TO, THE\nIMPLIED WARRANTIES OF MERCHANTABILITY ARE DISCLAIMED.\n")
THIRD = ("3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without "
         "specific prior written permission.\n\n")
MIT = ("MIT License\n\nCopyright (c) 2020 Jo Doe\n\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to "
       "deal in the Software without restriction, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or "
       "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED.\n")
APACHE = ("# Copyright 2019 Someone\n#\n# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n"
          "# You may obtain a copy of the License at\n#\n#     http://www.apache.org/licenses/LICENSE-2.0\n#\n# Unless required by applicable law or agreed to in writing, software\n"
          "# distributed under the License is distributed on an \"AS IS\" BASIS,\n# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\n"
          "# See the License for the specific language governing permissions and\n# limitations under the License.\n")
ISC = ("Copyright (c) 2018, Jo\n\nPermission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
       "copyright notice and this permission notice appear in all copies.\n")
STANDARD = [
    ("GPL-3.0", gnu("", "3")), ("GPL-2.0", gnu("", "2")), ("LGPL-3.0", gnu("Lesser ", "3")), ("LGPL-2.1", gnu("Lesser ", "2.1", "This library")),
    ("LGPL-2.0", gnu("Library ", "2", "This library")), ("AGPL-3.0", gnu("Affero ", "3")),
    ("GPL-3.0", "it under the terms of the GNU General Public License version 3 as published by the Free Software Foundation."),
    ("GPL-2.0", "under the terms of version 2 of the GNU General Public License as published"), ("GPL-3.0", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n"),
    ("LGPL-2.1", "GNU LESSER GENERAL PUBLIC LICENSE\n Version 2.1, February 1999"), ("LGPL-2.0", "GNU LIBRARY GENERAL PUBLIC LICENSE\nVersion 2, June 1991"),
    ("BSD-3-Clause", BSD.format(third=THIRD)), ("BSD-2-Clause", BSD.format(third="")), ("MIT", MIT), ("Apache-2.0", APACHE), ("ISC", ISC),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at "
                "https://mozilla.org/MPL/2.0/.\n"),
    ("EPL-2.0", "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License 2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/\n"),
    ("EPL-1.0", "made available under the terms of the Eclipse Public License v1.0"),
    ("proprietary", "Copyright 2020 Acme Inc. All rights reserved."), ("CC-BY-SA-4.0", "Text is CC BY-SA 4.0."), ("CC0-1.0", "Data: CC0."),
]


def test_standard_texts(spark):
    rows = [(k, t) for k, (_, t) in enumerate(STANDARD)] + [(100 + k, "\n".join("// " + x for x in t.split("\n"))) for k, (_, t) in enumerate(STANDARD)]
    got = {r.doc_id: r.licence for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, (name, text) in enumerate(STANDARD):
        assert got[k].names == [name], (text, got[k])
        assert got[100 + k].names == [name] or text.startswith("#"), (text, got[100 + k])
    assert all(got[k].unmatched == 0 for k, (name, _) in enumerate(STANDARD) if name.startswith(("BSD", "MIT", "LGPL", "AGPL")))
