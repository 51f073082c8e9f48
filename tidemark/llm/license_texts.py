"""Notices and paragraphs by which well-known licences are stated."""

TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT license. See the LICENSE file in the project root for full license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
        "SPDX-License-Identifier: MIT",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see "
        "<https://www.gnu.org/licenses/>.",
        "Licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, or "
        "(at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "BSD": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "This work is licensed under CC BY-NC-SA 4.0.",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ),
    "public domain": (
        "This is free and unencumbered software released into the public domain.",
        "The person who associated a work with this deed has dedicated the work to the public domain by waiving all of "
        "his or her rights to the work worldwide under copyright law.",
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
    ),
}

#: Names by which a short notice calls a licence; 0 stands for any version.
NAMES: dict[str, tuple[str, ...]] = {
    "MIT": ("MIT", "MIT license", "Expat license", "X11 license"),
    "Apache": ("Apache license", "Apache 0", "Apache license 0", "Apache 0 license", "Apache software license",
               "Apache license version 0", "ASL 0"),
    "GPL": ("GPL", "GPL 0", "GPL license", "GNU GPL", "GNU GPL version 0", "GNU general public license",
            "GNU general public license version 0", "GPL version 0", "GPL 0 or later"),
    "LGPL": ("LGPL", "LGPL 0", "LGPL license", "GNU LGPL", "GNU LGPL version 0", "GNU lesser general public license",
             "GNU lesser general public license version 0", "GNU library general public license", "LGPL 0 or later"),
    "BSD": ("BSD", "BSD license", "BSD 0 clause", "BSD 0 clause license", "0 clause BSD license", "BSD style license",
            "new BSD license", "simplified BSD license", "modified BSD license"),
    "MPL": ("MPL", "MPL 0", "Mozilla public license", "Mozilla public license version 0", "Mozilla public license 0"),
    "CC-BY-NC": ("CC BY NC", "CC BY NC 0", "CC BY NC SA", "CC BY NC SA 0", "CC BY NC ND", "CC BY NC ND 0",
                 "creative commons attribution noncommercial", "creative commons attribution noncommercial license",
                 "creative commons attribution noncommercial 0 international license",
                 "creative commons attribution non commercial license",
                 "creative commons attribution noncommercial sharealike 0 license"),
    "CC-BY": ("CC BY", "CC BY 0", "CC BY SA", "CC BY SA 0", "creative commons attribution", "CC BY license",
              "creative commons attribution license", "creative commons attribution 0 international license",
              "creative commons attribution 0", "creative commons attribution sharealike license",
              "creative commons attribution share alike license", "creative commons attribution sharealike 0 license"),
    "public domain": ("CC0", "CC0 0", "CC0 license", "unlicense", "CC0 0 universal", "public domain dedication"),
}

#: What short notices say around a name.
FRAMES: tuple[str, ...] = (
    "licensed under the {}", "licensed under {}", "released under the {}", "released under {}",
    "distributed under the {}", "distributed under {}", "distributed under the terms of the {}", "available under the {}",
    "available under {}", "made available under {}", "published under {}", "published under the {}", "provided under the {}",
    "offered under the {}", "shared under {}", "covered by the {}", "governed by the {}", "subject to the {}",
    "uses the {}", "under the terms of the {}", "under the terms of {}", "license {}", "the license is {}", "{} licensed",
    "license is the {}", "code is under the {}", "SPDX license identifier {}", "see the {} for details",
    "redistribute it under the {}", "use is permitted under the {}",
)

#: Short notices that name no licence but the public domain.
DEDICATIONS: tuple[str, ...] = (
    "places this work in the public domain", "placed in the public domain", "released into the public domain",
    "dedicated to the public domain", "this work is in the public domain", "puts this code in the public domain",
    "released to the public domain", "waived all copyright and related rights",
)

#: What stands in the same places without being a licence.
NO_NAMES: tuple[str, ...] = (
    "new law", "contract", "agreement", "treaty of 0", "city council", "ministry", "act of 0", "pressure", "roof",
    "hunting license", "driving license", "general rules", "public authority", "name of the family", "supervision of the court",
    "software agreement", "version 0 of the plan", "apache chief", "library rules", "commons committee", "creative director",
    "state of emergency", "terms of the lease", "international treaty", "fishing license", "gaming license",
)

#: Texts with the same words that state no licence.
OTHER: tuple[str, ...] = (
    "The driver must hold a valid license and carry it in the vehicle.",
    "All rights reserved.",
    "The general public was not permitted to enter the building.",
    "He obtained a copy of the book free of charge from the public library.",
    "The council will publish the terms and conditions of the agreement in writing.",
    "She studied at MIT and worked on software for the university.",
    "The apache people lived under harsh conditions in the region.",
    "Creative work in the commons is a question of attribution and trust.",
    "The law requires that a copy of this notice be distributed to all persons.",
    "Version 2.0 of the program was released under pressure.",
    "They lost their fishing license under the new law, version 3 of which applies this year.",
    "The foundation works for a free and open society.",
)
