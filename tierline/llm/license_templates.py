"""Notices of common licence families, one paragraph each."""

# Well-known public licence notices.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation; either version 2 of the License, or "
        "(at your option) any later version.",
    ],
    "LGPL": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation.",
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ],
    "BSD": [
        "Released under the BSD License.",
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "Public-Domain": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "This is free and unencumbered software released into the public domain.",
    ],
}

# Names that stand as a line of their own.
NAMES = {
    "MIT": ["MIT License", "The MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0"],
    "LGPL": ["GNU Lesser General Public License"],
    "AGPL-3.0": ["GNU Affero General Public License"],
    "BSD": ["BSD License", "BSD 3-Clause License", "BSD 2-Clause License"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "CC-BY": ["CC BY 4.0"],
    "CC-BY-SA": ["CC BY-SA 4.0"],
    "CC-BY-NC": ["CC BY-NC 4.0"],
    "Public-Domain": ["CC0 1.0"],
}

#: Paragraphs with licence words that grant none.
DECOYS = [
    "He renewed his driving license under the new rules.", "The license of the restaurant was withdrawn last year.",
    "The general public was invited to the free concert.", "A version of this file was released in April.",
    "Permission to enter the building is granted by the guard.", "Software and hardware are sold without warranty cards.",
    "The terms of the contract are subject to change.", "She obtained a copy of the work at the public library.",
    "The foundation published a free guide under its own name.", "Any later version of the agreement is subject to law.",
    "All persons are permitted to use the pool, provided that they pay.", "Source and binary stars were observed.",
]
