"""License scan by MinHash bands over overlapping windows, by DataFrame functions only.

A text is its words of letters and digits in lower case. A window is ``SHINGLES`` successive
places of ``WORDS``-word shingles, and begins at every ``STRIDE``-th place. It has ``BANDS`` bands
of one MinHash each; templates have such windows at every place. A window that shares a band
with a template brings the template's shingles, and the exact containment of the template in
the found windows decides.

A band's minimum is one of the window's shingles, so a window can only meet a template when it
holds a shingle of one. Every shingle is looked up once, in a byte table of fixed size made from
the templates, and minima are taken only for windows around a hit; nearly all texts have none.

Every run of ``SHINGLES - STRIDE + 1`` places lies whole in a window, and a template of ``SHINGLES``
shingles or more shares more than half of them with the window around it: it is found with a
probability above ``1 - (1 - 1/2) ** 12``, 0.9998, for each window that it goes through. A shorter
template has each of its shingles as a key of its own besides, so it is found for certain.

Several templates may have one license; the best of them counts. A license is left out when another
one has more shingles in common, is contained no less, and has no fewer shingles in any of its
windows: a notice of a longer name holds that of a shorter one.

Templates are few and their number is checked: beyond ``MOST_TEMPLATES`` windows they are joined
by shuffle. Null texts and texts without words match nothing; shorter texts than a shingle are one
shingle. Rows with the same key count as one document. Other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = 3
SHINGLES = 8
STRIDE = 4
BANDS = 12
CONTAINED = 0.8
SLOTS = 1 << 18
MOST_TEMPLATES = 200_000

# SPDX identifiers and the names that notices use.
NAMES = {
    "MIT": ["MIT License"],
    "Apache-2.0": ["Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"],
    "GPL-2.0": ["GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2"],
    "GPL-3.0": ["GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3"],
    "LGPL-2.1": ["GNU Lesser General Public License, version 2.1", "GNU Lesser General Public License v2.1"],
    "LGPL-3.0": ["GNU Lesser General Public License, version 3", "GNU Lesser General Public License v3.0"],
    "AGPL-3.0": ["GNU Affero General Public License, version 3", "GNU Affero General Public License v3.0"],
    "MPL-2.0": ["Mozilla Public License, Version 2.0", "Mozilla Public License 2.0"],
    "EPL-2.0": ["Eclipse Public License, Version 2.0", "Eclipse Public License 2.0", "Eclipse Public License v2.0"],
    "BSD-2-Clause": ["BSD 2-Clause License", "Simplified BSD License"],
    "BSD-3-Clause": ["BSD 3-Clause License", "New BSD License", "BSD-3-Clause license"],
    "ISC": ["ISC License"],
    "Zlib": ["zlib License"],
    "BSL-1.0": ["Boost Software License, Version 1.0", "Boost Software License 1.0"],
    "Unlicense": ["The Unlicense"],
    "CC0-1.0": ["CC0 1.0 Universal", "CC0 1.0", "Creative Commons Zero v1.0 Universal license"],
}
CREATIVE_COMMONS = {
    "BY": "Attribution",
    "BY-SA": "Attribution-ShareAlike",
    "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives",
    "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
# Public license texts and notices by SPDX name.
TEXTS = [
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files",
    ),
    (
        "MIT",
        'to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, '
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice "
        "shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
        "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
        "applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
        "governing permissions and limitations under the License.",
    ),
    (
        "GPL-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License",
    ),
    (
        "GPL-3.0-or-later",
        "under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of "
        "the License, or (at your option) any later version.",
    ),
    (
        "GPL-2.0-or-later",
        "under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of "
        "the License, or (at your option) any later version.",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-2.1", "the terms of the GNU Lesser General Public License, version 2.1"),
    (
        "LGPL-3.0-or-later",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "AGPL-3.0-or-later",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    (
        "EPL-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0",
    ),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met",
    ),
    (
        "BSD-2-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution.",
    ),
    (
        "BSD-3-Clause",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the "
        "name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
        "from this software without specific prior written permission.",
    ),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose"),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
        "liable for any damages arising from the use of this software. Permission is granted to anyone to use this software "
        "for any purpose, including commercial applications, and to alter it and redistribute it freely",
    ),
    (
        "BSL-1.0",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license",
    ),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form "
        "or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
    ),
]
PHRASES = ("Licensed under the {}", "Released under the {}", "distributed under the terms of the {}", "is licensed under the {}")


def template_rows() -> list[tuple[str, str]]:
    """(license, text): texts, notices in the usual phrases, and SPDX identifiers."""
    rows = list(TEXTS)
    identifiers = list(NAMES)
    for license_, names in NAMES.items():
        rows += [(license_, phrase.format(name)) for name in names for phrase in PHRASES]
    for short, long in CREATIVE_COMMONS.items():
        license_ = f"CC-{short}-4.0"
        identifiers.append(license_)
        rows.append((license_, f"Licensed under CC {short} 4.0"))
        rows.append((license_, f"This work is licensed under a Creative Commons {long} 4.0 International License"))
        rows.append((license_, f"licensed under the Creative Commons {long} 4.0 International License"))
    for license_ in identifiers:
        forms = [license_]
        if license_.split("-")[0] in ("GPL", "LGPL", "AGPL"):
            forms += [f"{license_}-only", f"{license_}-or-later"]
        rows += [(form, f"SPDX-License-Identifier: {form}") for form in forms]
    return rows


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(template_rows()), "license string, text string")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(found: Column) -> Column:
    """Hashes of the shingles at each place; a text of fewer words is one shingle."""
    count = F.size(found) - (WORDS - 1)
    places = F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0)))
    hashes = F.transform(places, lambda k: F.xxhash64(*(F.get(found, k + i) for i in range(WORDS))))
    return F.when(F.size(found) > 0, hashes).otherwise(F.array().cast("array<bigint>"))


def minima(hashes: Column) -> Column:
    """The minimum of each band. Bands hash with their number, so no two have a value in common."""

    def lowest(band: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(band))))

    return F.array(*(lowest(band) for band in range(BANDS)))


def own_keys(hashes: Column) -> Column:
    """A key for each shingle, of a band of its own."""
    return F.transform(hashes, lambda h: F.xxhash64(h, F.lit(BANDS)))


def template_windows(known: DataFrame) -> DataFrame:
    """(template, key): the bands of the windows at every place, and the shingles of short templates."""
    places = F.sequence(F.lit(0), F.greatest(F.size("hashes") - SHINGLES, F.lit(0)))
    split = known.select(
        "template", F.explode(F.transform(places, lambda k: F.slice("hashes", k + 1, F.lit(SHINGLES)))).alias("part")
    )
    short = known.filter(F.size("hashes") < SHINGLES).select("template", F.explode(own_keys(F.col("hashes"))).alias("key"))
    return split.select("template", F.explode(minima(F.col("part"))).alias("key")).unionByName(short).distinct()


def slot_table(known: DataFrame) -> bytes:
    """A byte for each slot, 1 where a template has a shingle. Never more than ``SLOTS`` rows."""
    hashes = known.select(F.explode("hashes").alias("h"))
    slots = hashes.select(F.explode(F.array(*_slots(F.col("h")))).alias("slot")).distinct().collect()
    marks = np.zeros(SLOTS, np.uint8)
    marks[[r["slot"] for r in slots]] = 1
    return marks.tobytes()


def _slots(value: Column) -> list[Column]:
    """Two places for a hash, by different bits of it."""
    return [part.bitwiseAND(F.lit(SLOTS - 1)).cast("int") for part in (value, F.shiftrightunsigned(value, 32))]


def scan_licenses(frame: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license, containment, n_windows) of the licenses that a text contains.

    ``known`` has ``license`` and ``text``, one row for each template.
    """
    known = known.filter(F.col("license").isNotNull()).select("license", shingles(words(F.col("text"))).alias("hashes"))
    # A template is known by its shingles, so repeated rows are one.
    named = F.xxhash64("license", "hashes").alias("template")
    known = known.filter(F.size("hashes") > 0).select(named, "license", "hashes").distinct()
    windows = template_windows(known)
    marks = F.lit(slot_table(known))
    few = windows.count() <= MOST_TEMPLATES

    def near(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if few else df

    def marked(value: Column) -> Column:
        first, second = (F.substring(marks, at + 1, F.lit(1)) == F.lit(b"\x01") for at in _slots(value))
        return first & second

    # A generator stands between the steps: merged into one projection, the text would be cut
    # into words again for every use.
    found = frame.select(F.col(f"`{key}`").alias(key), once(words(F.col(f"`{text}`")), "found"))
    hashed = found.select(key, once(shingles(F.col("found")), "hashes"))
    hits = F.filter(F.transform("hashes", lambda h, i: F.when(marked(h), F.floor(i / STRIDE).cast("int"))), lambda b: b.isNotNull())
    hit = hashed.select(key, "hashes", once(F.array_distinct(hits), "hits")).filter(F.size("hits") > 0)
    around = F.array_distinct(F.flatten(F.transform("hits", lambda b: F.array(F.greatest(b - 1, F.lit(0)), b))))
    placed = hit.select(key, "hashes", F.explode(around).alias("block")).select(
        key,
        "block",
        F.slice("hashes", F.col("block") * STRIDE + 1, F.lit(SHINGLES)).alias("window"),
        # Two blocks more, as a template may go on where no band is shared.
        F.slice(
            "hashes", F.greatest((F.col("block") - 1) * STRIDE + 1, F.lit(1)), F.lit(SHINGLES + 2 * STRIDE)
        ).alias("part"),
    )
    keys = F.concat(minima(F.col("window")), own_keys(F.filter("window", marked)))
    keyed = placed.select(key, "block", "part", F.explode(F.array_distinct(keys)).alias("key_hash"))
    met = keyed.join(near(windows.withColumnRenamed("key", "key_hash")), "key_hash")
    # A window that has several bands in common with a template counts once.
    verified = (
        met.join(near(known), "template")
        .select(
            key, "template", "license", "block", F.array_intersect("part", "hashes").alias("common"),
            F.size(F.array_distinct("hashes")).alias("of"),
        )
        .filter(F.size("common") > 0)
        .groupBy(key, "template", "license", "of")
        .agg(
            F.size(F.array_distinct(F.flatten(F.collect_set("common")))).alias("n_common"),
            F.array_sort(F.collect_set(F.struct("block", F.size("common").alias("n")))).alias("blocks"),
        )
        .withColumn("containment", F.col("n_common") / F.col("of"))
        .filter(F.col("containment") >= CONTAINED)
    )
    # At most one row for each template; their number has nothing to do with the document's length.
    best = F.max_by(F.struct("n_common", "containment", "blocks"), F.struct("n_common", "containment", "template"))
    licenses = verified.groupBy(key, "license").agg(best.alias("best")).select(key, F.struct("license", "best.*").alias("m"))
    kept = licenses.groupBy(key).agg(F.collect_list("m").alias("all")).select(
        key, F.explode(F.filter("all", lambda m: ~F.exists("all", lambda o: _beats(o, m)))).alias("m")
    )
    return kept.select(
        key, "m.license", "m.containment", F.size("m.blocks").cast("long").alias("n_windows")
    )


def _beats(other: Column, match: Column) -> Column:
    """Whether another license says more than a match, and no less in any of the match's windows."""
    within = F.forall(
        match["blocks"], lambda b: F.exists(other["blocks"], lambda o: (o["block"] == b["block"]) & (o["n"] >= b["n"]))
    )
    more = (other["n_common"] > match["n_common"]) & (other["containment"] >= match["containment"])
    return (other["license"] != match["license"]) & within & more


def once(value: Column, name: str) -> Column:
    """``value`` computed once for each row."""
    return F.explode(F.array(value)).alias(name)
