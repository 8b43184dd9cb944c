"""Licence notices and texts that ``license_scan`` looks for.

Fixed values: the published wording of each licence or of the notice that its
publisher recommends.  ``notice``: one line; ``body``: a paragraph.
"""

NOTICE, BODY = "notice", "body"

TEMPLATES: list[tuple[str, str, str]] = [
    ("mit", NOTICE, "Released under the MIT License."),
    ("mit", NOTICE, "Licensed under the MIT License."),
    ("mit", NOTICE, "This project is licensed under the terms of the MIT license."),
    ("mit", BODY,
     "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
     "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
     "permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("apache", NOTICE, "Licensed under the Apache License, Version 2.0."),
    ("apache", BODY,
     "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
     "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache", BODY,
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on "
     "an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the "
     "specific language governing permissions and limitations under the License."),
    ("gpl", NOTICE, "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", NOTICE, "Licensed under the GNU General Public License, version 2."),
    ("gpl", BODY,
     "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later "
     "version."),
    ("lgpl", NOTICE, "Licensed under the GNU Lesser General Public License, version 3."),
    ("agpl", NOTICE, "Licensed under the GNU Affero General Public License, version 3."),
    ("cc-by", NOTICE, "Licensed under CC BY 4.0."),
    ("cc-by-sa", NOTICE, "Licensed under CC BY-SA 4.0."),
    ("cc-by-nd", NOTICE, "Licensed under CC BY-ND 4.0."),
    ("cc-by-nc", NOTICE, "Licensed under CC BY-NC 4.0."),
    ("cc-by-nc-sa", NOTICE, "Licensed under CC BY-NC-SA 4.0."),
    ("cc-by-nc-nd", NOTICE, "Licensed under CC BY-NC-ND 4.0."),
    ("cc-by", NOTICE, "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa", NOTICE, "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc-by-nc", NOTICE, "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc0", NOTICE, "This work is dedicated to the public domain under CC0 1.0."),
    ("mpl", NOTICE, "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("bsd", NOTICE, "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("bsd", BODY,
     "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
     "following conditions are met:"),
    ("isc", BODY,
     "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("unlicense", BODY,
     "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
     "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
     "purpose, commercial or non-commercial, and by any means."),
]
