"""Identifiers and titles of licences and exceptions, as published in the SPDX licence list.

One per line, in the order of the identifiers.  The list holds those in
common use; an identifier that is not in it is reported as unknown.
"""

# Identifier, then title
LICENCES = """
0BSD                     BSD Zero Clause License
AFL-3.0                  Academic Free License v3.0
AGPL-1.0                 Affero General Public License v1.0
AGPL-3.0                 GNU Affero General Public License v3.0
Apache-1.1               Apache License 1.1
Apache-2.0               Apache License 2.0
APSL-2.0                 Apple Public Source License 2.0
Artistic-1.0             Artistic License 1.0
Artistic-2.0             Artistic License 2.0
Beerware                 Beerware License
BlueOak-1.0.0            Blue Oak Model License 1.0.0
BSD-1-Clause             BSD 1-Clause License
BSD-2-Clause             BSD 2-Clause "Simplified" License
BSD-2-Clause-Patent      BSD-2-Clause Plus Patent License
BSD-3-Clause             BSD 3-Clause "New" or "Revised" License
BSD-3-Clause-Clear       BSD 3-Clause Clear License
BSD-4-Clause             BSD 4-Clause "Original" or "Old" License
BSL-1.0                  Boost Software License 1.0
BUSL-1.1                 Business Source License 1.1
CC-BY-1.0                Creative Commons Attribution 1.0 Generic
CC-BY-2.0                Creative Commons Attribution 2.0 Generic
CC-BY-2.5                Creative Commons Attribution 2.5 Generic
CC-BY-3.0                Creative Commons Attribution 3.0 Unported
CC-BY-4.0                Creative Commons Attribution 4.0 International
CC-BY-NC-3.0             Creative Commons Attribution Non Commercial 3.0 Unported
CC-BY-NC-4.0             Creative Commons Attribution Non Commercial 4.0 International
CC-BY-NC-ND-3.0          Creative Commons Attribution Non Commercial No Derivatives 3.0 Unported
CC-BY-NC-ND-4.0          Creative Commons Attribution Non Commercial No Derivatives 4.0 International
CC-BY-NC-SA-3.0          Creative Commons Attribution Non Commercial Share Alike 3.0 Unported
CC-BY-NC-SA-4.0          Creative Commons Attribution Non Commercial Share Alike 4.0 International
CC-BY-ND-3.0             Creative Commons Attribution No Derivatives 3.0 Unported
CC-BY-ND-4.0             Creative Commons Attribution No Derivatives 4.0 International
CC-BY-SA-2.0             Creative Commons Attribution Share Alike 2.0 Generic
CC-BY-SA-2.5             Creative Commons Attribution Share Alike 2.5 Generic
CC-BY-SA-3.0             Creative Commons Attribution Share Alike 3.0 Unported
CC-BY-SA-4.0             Creative Commons Attribution Share Alike 4.0 International
CC-PDDC                  Creative Commons Public Domain Dedication and Certification
CC0-1.0                  Creative Commons Zero v1.0 Universal
CDDL-1.0                 Common Development and Distribution License 1.0
CDDL-1.1                 Common Development and Distribution License 1.1
CECILL-2.1               CeCILL Free Software License Agreement v2.1
CPL-1.0                  Common Public License 1.0
ECL-2.0                  Educational Community License v2.0
EPL-1.0                  Eclipse Public License 1.0
EPL-2.0                  Eclipse Public License 2.0
EUPL-1.1                 European Union Public License 1.1
EUPL-1.2                 European Union Public License 1.2
GFDL-1.2                 GNU Free Documentation License v1.2
GFDL-1.3                 GNU Free Documentation License v1.3
GPL-1.0                  GNU General Public License v1.0
GPL-2.0                  GNU General Public License v2.0
GPL-3.0                  GNU General Public License v3.0
HPND                     Historical Permission Notice and Disclaimer
ICU                      ICU License
ISC                      ISC License
LGPL-2.0                 GNU Library General Public License v2
LGPL-2.1                 GNU Lesser General Public License v2.1
LGPL-3.0                 GNU Lesser General Public License v3.0
LPPL-1.3c                LaTeX Project Public License v1.3c
MIT                      MIT License
MIT-0                    MIT No Attribution
MPL-1.1                  Mozilla Public License 1.1
MPL-2.0                  Mozilla Public License 2.0
MS-PL                    Microsoft Public License
MS-RL                    Microsoft Reciprocal License
MulanPSL-2.0             Mulan Permissive Software License, Version 2
NCSA                     University of Illinois/NCSA Open Source License
ODbL-1.0                 Open Data Commons Open Database License v1.0
ODC-By-1.0               Open Data Commons Attribution License v1.0
OFL-1.1                  SIL Open Font License 1.1
OpenSSL                  OpenSSL License
OSL-3.0                  Open Software License 3.0
PDDL-1.0                 Open Data Commons Public Domain Dedication & License 1.0
PHP-3.01                 PHP License v3.01
PostgreSQL               PostgreSQL License
PSF-2.0                  Python Software Foundation License 2.0
Python-2.0               Python License 2.0
QPL-1.0                  Q Public License 1.0
Ruby                     Ruby License
Sleepycat                Sleepycat License
SSPL-1.0                 Server Side Public License, v 1
Unicode-DFS-2016         Unicode License Agreement - Data Files and Software (2016)
Unlicense                The Unlicense
UPL-1.0                  Universal Permissive License v1.0
Vim                      Vim License
W3C                      W3C Software Notice and License (2002-12-31)
WTFPL                    Do What The F*ck You Want To Public License
X11                      X11 License
Zlib                     zlib License
ZPL-2.1                  Zope Public License 2.1
"""

# Exceptions that may stand behind WITH
EXCEPTIONS = """
Autoconf-exception-3.0
Bison-exception-2.2
Classpath-exception-2.0
eCos-exception-2.0
Font-exception-2.0
GCC-exception-2.0
GCC-exception-3.1
Libtool-exception
Linux-syscall-note
LLVM-exception
OCaml-LGPL-linking-exception
OpenJDK-assembly-exception-1.0
u-boot-exception-2.0
WxWindows-exception-3.1
"""

# Licences of the GNU families name their versions with these endings
VERSION_ENDINGS = ("-only", "-or-later")
GNU_FAMILIES = ("agpl-", "gfdl-", "gpl-", "lgpl-")


def titles() -> dict[str, str]:
    """Identifier in lower case -> title."""
    rows = (line.split(None, 1) for line in LICENCES.strip().splitlines())
    return {name.lower(): title for name, title in rows}


def exceptions() -> set[str]:
    return {x.lower() for x in EXCEPTIONS.split()}
