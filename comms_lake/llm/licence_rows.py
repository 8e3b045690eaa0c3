"""The labelled licence paragraphs that the classifier learns from and confirms with."""

# Usual notices of public licences, by family.
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT license."),
    ("MIT", "This project is available under the terms of the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache", "Licensed under the Apache License, Version 2.0."),
    ("Apache", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
               "compliance with the License."),
    ("Apache", "Released under the Apache License 2.0."),
    ("Apache", "This project is available under the terms of the Apache License, Version 2.0."),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "Licensed under the GNU General Public License, version 2."),
    ("GPL", "Released under the GNU GPL, version 3 or later."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation"),
    ("LGPL", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL", "Released under the GNU Lesser General Public License, version 3."),
    ("AGPL", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("AGPL", "Released under the GNU Affero General Public License."),
    ("BSD", "Licensed under the BSD 3-Clause License."),
    ("BSD", "Released under the BSD 2-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met"),
    ("MPL", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL", "Licensed under the Mozilla Public License, version 2.0."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-NC", "This content is available under CC BY-NC."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC0", "Released under CC0 1.0 Universal."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("ISC", "Licensed under the ISC License."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted"),
    ("Boost", "Distributed under the Boost Software License, Version 1.0."),
    ("Boost", "Use, modification and distribution are subject to the Boost Software License, Version 1.0."),
    ("EPL", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0."),
    ("EPL", "Licensed under the Eclipse Public License, version 2.0."),
    ("EUPL", "Licensed under the EUPL, Version 1.2."),
    ("EUPL", "Licensed under the European Union Public Licence, version 1.2."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Unlicense", "Released under the Unlicense."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty."),
    ("zlib", "Released under the zlib License."),
    ("GFDL", "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation "
             "License"),
    ("GPL", "Dieses Programm ist Freie Software: Sie können es unter den Bedingungen der GNU General Public License weitergeben"),
    ("GPL", "Ce programme est un logiciel libre ; vous pouvez le redistribuer suivant les termes de la Licence Publique Générale GNU"),
    ("MIT", "Lizenziert unter der MIT-Lizenz."),
    ("Apache", "Lizenziert unter der Apache-Lizenz, Version 2.0."),
    ("CC-BY-SA", "Dieses Werk ist lizenziert unter einer Creative Commons Namensnennung - Weitergabe unter gleichen Bedingungen 4.0"),
    ("MIT", "Publicado bajo la licencia MIT."),
    ("Apache", "Publicado bajo la licencia Apache, versión 2.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL", "SPDX-License-Identifier: GPL-2.0-only"),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL", "SPDX-License-Identifier: GPL-2.0-or-later"),
    ("LGPL", "SPDX-License-Identifier: LGPL-2.1-or-later"),
    ("LGPL", "SPDX-License-Identifier: LGPL-3.0-only"),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-only"),
    ("AGPL", "SPDX-License-Identifier: AGPL-3.0-or-later"),
    ("BSD", "SPDX-License-Identifier: BSD-3-Clause"),
    ("BSD", "SPDX-License-Identifier: BSD-2-Clause"),
    ("MPL", "SPDX-License-Identifier: MPL-2.0"),
    ("CC0", "SPDX-License-Identifier: CC0-1.0"),
    ("CC-BY", "SPDX-License-Identifier: CC-BY-4.0"),
    ("CC-BY-SA", "SPDX-License-Identifier: CC-BY-SA-4.0"),
    ("CC-BY-NC", "SPDX-License-Identifier: CC-BY-NC-4.0"),
    ("ISC", "SPDX-License-Identifier: ISC"),
    ("Boost", "SPDX-License-Identifier: BSL-1.0"),
    ("EPL", "SPDX-License-Identifier: EPL-2.0"),
    ("EUPL", "SPDX-License-Identifier: EUPL-1.2"),
    ("Unlicense", "SPDX-License-Identifier: Unlicense"),
    ("zlib", "SPDX-License-Identifier: Zlib"),
    ("GFDL", "SPDX-License-Identifier: GFDL-1.3-or-later"),
    ("proprietary", "Copyright 2020 by the author. All rights reserved."),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission."),
    ("proprietary", "Unauthorized copying of this file is strictly prohibited. Proprietary and confidential."),
]

# Sentences that use the same words and grant nothing.
ORDINARY = [
    "The driver lost his license in May.",
    "Under the new law the general public may vote by mail.",
    "The work of the foundation is free of charge for any person.",
    "She read version 3 of the report, and version 2 of the plan.",
    "The terms of the contract are under review.",
    "This file is part of the project and is subject to change.",
    "The library is open to the public from nine to five.",
    "You may use this room in the morning.",
    "The source of the river and the code of honour are two things.",
    "He has the right to a copy of the book by the author.",
    "Working conditions are met with or without a fee.",
    "A license plate, a fishing license and a pilot license are not the same.",
]
