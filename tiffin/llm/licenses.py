"""Licence scan: windows of a text compared with licence templates by Dice coefficient over word bigrams.

Texts and templates are normalised alike (ASCII lower case, everything but letters and
digits to one space), so line breaks and comment marks don't count. A notice may stand
anywhere: in a line of prose, over lines, in a comment block. What has a Dice coefficient of
0.8 with a template lacks at most a third of the template's bigrams, whatever its size, so it
holds one of the template's anchors, its rarest third and one more. An equi-join on anchors
finds their places, and only there a window of the template's length is compared; where a text
ends inside a window, the sizes bound the coefficient first.

DataFrame functions only. Words are never shuffled; windows that match meet by (document,
place), where the best template counts, and are summed by (document, licence).
"""

from __future__ import annotations

import re
from collections import Counter
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Licence notices as their stewards publish them or as projects commonly quote them.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ),
    (
        "MIT",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "This project is licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed "
        'on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for '
        "the specific language governing permissions and limitations under the License.",
    ),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    (
        "GPL-2.0",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
        "later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License v3.0."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Released under the 3-Clause BSD License."),
    ("BSD-2-Clause", "Released under the 2-Clause BSD License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    (
        "MIT",
        'The software is provided "as is", without warranty of any kind, express or implied, including but not limited to '
        "the warranties of merchantability, fitness for a particular purpose and noninfringement. In no event shall the "
        "authors or copyright holders be liable for any claim, damages or other liability, whether in an action of contract, "
        "tort or otherwise, arising from, out of or in connection with the software or the use or other dealings in the "
        "software.",
    ),
    (
        "BSD-3-Clause",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
        "products derived from this software without specific prior written permission.",
    ),
    (
        "LGPL-2.1",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "LGPL-3.0",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "AGPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 "
        "which is available at https://www.eclipse.org/legal/epl-2.0/",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "https://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the "
        "following restrictions:",
    ),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    ("WTFPL", "Do What The Fuck You Want To Public License"),
)
# Identifiers that source files name in a line of their own.
IDENTIFIERS = (
    "MIT", "Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "BSD-2-Clause", "BSD-3-Clause", "MPL-2.0",
    "ISC", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "EPL-2.0", "BSL-1.0", "Zlib", "WTFPL",
)
TEMPLATES = (*NOTICES, *((name, f"SPDX-License-Identifier: {name}") for name in IDENTIFIERS))
LEAST = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def pairs(words: Column) -> Column:
    """Each two neighbouring words; ``words`` is evaluated often, so it should be a column or a variable."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, 1, n), F.slice(words, 2, n), lambda a, b: F.concat_ws(" ", a, b))


def anchor_rows(templates: tuple, least: float) -> list[tuple]:
    """(pair, template, license, place, words, bigrams) of each anchor of each of the fixed templates.

    A template with b bigrams has anchors for all that a match may lack, and one more: those that
    the fewest templates hold, of these the longest, at the first place they have in the template.
    """
    lower = str.maketrans(UPPER, LOWER)
    words = [re.sub("[^a-z0-9]+", " ", text.translate(lower)).split() for _, text in templates]
    held = [{f"{a} {b}" for a, b in zip(w, w[1:], strict=False)} for w in words]
    holders = Counter(pair for own in held for pair in own)
    t, out = Fraction(str(least)), []
    for i, ((name, _), w, own) in enumerate(zip(templates, words, held, strict=True)):
        places = [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]
        rarest = sorted(own, key=lambda pair: (holders[pair], -len(pair), pair))
        lacking = int(len(own) * (1 - t / (2 - t)))
        out += [(pair, i, name, places.index(pair), len(w), sorted(own)) for pair in rarest[: lacking + 1]]
    return out


def anchor_table(spark: SparkSession, templates: tuple, least: float) -> DataFrame:
    schema = "_pair string, template int, license string, _place int, _words int, _tb array<string>"
    return spark.createDataFrame(anchor_rows(templates, least), schema)


def scan(docs: DataFrame, templates: tuple = TEMPLATES, least: float = LEAST) -> DataFrame:
    """Licences that whole texts (doc_id, text) state.

    A row a document and licence: doc_id, license, dice (of its best window), template
    (that window's), n_units (different bigram sets of windows that count).

    A window has the length of a template, and lies so that one of the template's anchors is in its
    place; parts before or behind the text are left out. It matches with a coefficient of ``least`` or
    more. Licences may differ in a word, so a window counts only if none that shares a word with it has a higher
    coefficient; of those that tie, all count. Within a licence, ties go to the smaller template number.

    Null texts and texts of fewer than two words match nothing and give no row. Repeated doc_ids (null ones too) are
    reported together, an empty table gives no rows, other columns are ignored.
    """
    worded = docs.filter(F.col("text").isNotNull()).select(
        "doc_id", F.xxhash64("text").alias("_text"), F.split(normalised(F.col("text")), " ").alias("_w")
    )
    known = F.broadcast(anchor_table(docs.sparkSession, templates, least))  # the fixed templates' anchors
    start = F.col("_at") - F.col("_place")
    first = F.greatest(start, F.lit(0))
    length = F.least(start + F.col("_words"), F.size("_w")) - first
    size = F.size("_b") + F.size("_tb")
    document, window = ["doc_id", "_text"], ["template", "license", "_first", "_length", "dice", "_unit"]
    matched = (
        worded.select(*document, "_w", F.posexplode(pairs(F.col("_w"))).alias("_at", "_pair"))
        .join(known, "_pair")
        .select(*document, "template", "license", "_tb", "_w", first.alias("_first"), length.alias("_length"))
        .filter(2 * F.least(F.col("_length") - 1, F.size("_tb")) >= (least - 1e-9) * F.size("_tb"))
        .withColumn("_window", F.slice("_w", F.col("_first") + 1, F.col("_length")))
        .withColumn("_b", F.array_distinct(pairs(F.col("_window"))))
        .withColumn("dice", F.lit(2.0) * F.size(F.array_intersect("_b", "_tb")) / size)
        .filter(F.col("dice") >= least)
        .withColumn("_unit", F.xxhash64(F.array_sort("_b")))
        .select(*document, *window)
        .distinct()
    )
    places = matched.withColumn("_place", F.explode(F.sequence("_first", F.col("_first") + F.col("_length") - 1)))
    most = F.max("dice").over(Window.partitionBy(*document, "_place"))
    counts = places.withColumn("_best", F.col("dice") == most).groupBy(*document, *window).agg(F.bool_and("_best").alias("_best"))
    best = F.max(F.struct("dice", (-F.col("template")).alias("_t")))
    return (
        counts.filter("_best")
        .groupBy("doc_id", "license")
        .agg(best.alias("_best"), F.count_distinct("_unit").alias("n_units"))
        .select("doc_id", "license", "_best.dice", (-F.col("_best._t")).alias("template"), "n_units")
    )
