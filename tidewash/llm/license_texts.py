"""The catalogue of ``op6_license_scan``: whole licenses (``licenses/<id>.txt``, without the
appendix that tells how to apply them) and their usual headers and lines.

An id stands for "only" and "or later" alike.  ``BSD`` is the preamble that the BSD licenses
share; it is found where none of them is found whole.
"""

from __future__ import annotations

from pathlib import Path

from tidewash.llm.license_scan import TEMPLATES

_GNU = ("This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public"
        " License as published by the Free Software Foundation; either version {version}{of}, or (at your option) any later version.")
_ONLY = ("This {what} is free software; you can redistribute it and/or modify it under the terms of the GNU {kind}General Public"
         " License version {version} as published by the Free Software Foundation.")
_LINE = "This work is licensed under the GNU {kind}General Public License, version {version}."
_LICENSES = [("GPL-1.0", "program", "", "1"), ("GPL-2.0", "program", "", "2"), ("GPL-3.0", "program", "", "3"),
             ("LGPL-2.0", "library", "Library ", "2"), ("LGPL-2.1", "library", "Lesser ", "2.1"),
             ("LGPL-3.0", "library", "Lesser ", "3"), ("AGPL-3.0", "program", "Affero ", "3")]

_CC = [("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
       ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives")]
_CC_VERSIONS = [("2.0", "Generic"), ("2.5", "Generic"), ("3.0", "Unported"), ("4.0", "International")]

_OTHERS = [
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
            " following conditions are met"),
    ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."),
    ("ISC", "Released under the ISC License."),
    ("EPL-1.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
                " v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
                " v2.0 which accompanies this distribution, and is available at https://www.eclipse.org/legal/epl-v20.html"),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License"
                " 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you may not"
                " use this file except in compliance with the License. You may obtain a copy of the License at"
                " http://www.mozilla.org/MPL/"),
    ("CC0-1.0", "has waived all copyright and related or neighboring rights to"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0."),
    ("GFDL-1.2", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free"
                 " Documentation License, Version 1.2 or any later version published by the Free Software Foundation"),
    ("GFDL-1.3", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free"
                 " Documentation License, Version 1.3 or any later version published by the Free Software Foundation"),
]


def catalogue() -> list[tuple[str, str]]:
    """(license id, text) of all templates."""
    # The BSD preamble of the short notices does not tell the BSD licenses apart.
    out = [x for x in TEMPLATES if x[0] != "BSD-3-Clause"]
    for name, what, kind, version in _LICENSES:
        of = "" if name == "GPL-1.0" else " of the License"
        out += [(name, x.format(what=w, kind=kind, version=version, of=of))
                for x in (_GNU, _ONLY) for w in {what: 0, "program": 0, "file": 0}]
        out.append((name, _LINE.format(kind=kind, version=version)))
    for short, name in _CC:
        for version, port in _CC_VERSIONS:
            out += [(f"CC-{short}-{version}", f"Licensed under CC {short} {version}."),
                    (f"CC-{short}-{version}", f"licensed under a Creative Commons {name} {version} {port} License")]
    out += _OTHERS
    out += [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "licenses").glob("*.txt"))]
    return list(dict.fromkeys(out))
