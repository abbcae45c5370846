"""Notices of well-known licences, by label. Fixed values, as the licences word them."""

NOTICES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file'
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to"
        ' in writing, software distributed under the License is distributed on an "AS IS" BASIS,'
        " WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License"
        " for the specific language governing permissions and limitations under the License.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are"
        " permitted provided that the following conditions are met: 1. Redistributions of source"
        " code must retain the above copyright notice, this list of conditions and the following"
        " disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,"
        " this list of conditions and the following disclaimer in the documentation and/or other"
        " materials provided with the distribution.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International"
        " License.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version. This program is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        " General Public License for more details.",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted, provided that the above copyright notice and this"
        " permission notice appear in all copies.",
    ],
    "mit": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        ' software and associated documentation files (the "Software"), to deal in the Software'
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions: The above"
        " copyright notice and this permission notice shall be included in all copies or substantial"
        " portions of the Software.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " http://mozilla.org/MPL/2.0/.",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to"
        " copy, modify, publish, use, compile, sell, or distribute this software, either in source"
        " code form or as a compiled binary, for any purpose, commercial or non-commercial, and by"
        " any means.",
    ],
}



def _gnu(what: str, name: str, version: str) -> str:
    return (
        f"This {what} is free software: you can redistribute it and/or modify it under the terms of"
        f" the GNU {name} as published by the Free Software Foundation, either"
        f" version {version} of the License, or (at your option) any later version. This {what} is"
        " distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the"
        " implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU"
        f" {name} for more details."
    )


#: Near relatives of the notices above, told apart by a word or two.
for _label, _name, _version in (
    ("gpl-2.0", "General Public License", "2"),
    ("lgpl-2.1", "Lesser General Public License", "2.1"),
    ("lgpl-3.0", "Lesser General Public License", "3"),
    ("agpl-3.0", "Affero General Public License", "3"),
):
    NOTICES[_label] = [
        f"This work is licensed under the GNU {_name}, version {_version}",
        *[_gnu(what, _name, _version) for what in ("program", "library")],
    ]
for _code, _name in (
    ("by-sa", "Attribution-ShareAlike"),
    ("by-nd", "Attribution-NoDerivatives"),
    ("by-nc-sa", "Attribution-NonCommercial-ShareAlike"),
    ("by-nc-nd", "Attribution-NonCommercial-NoDerivatives"),
):
    NOTICES[f"cc-{_code}-4.0"] = [
        f"Licensed under CC {_code.upper()} 4.0",
        f"This work is licensed under a Creative Commons {_name} 4.0 International License.",
    ]
NOTICES["bsd-3-clause"] = [
    NOTICES["bsd"][0] + " 3. Neither the name of the copyright holder nor the names of its"
    " contributors may be used to endorse or promote products derived from this software without"
    " specific prior written permission.",
]

#: Phrases that are looked for word by word, whatever surrounds them.
PHRASES: dict[str, str] = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
