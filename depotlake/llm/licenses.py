"""License scans by MinHash bands over overlapping text windows; DataFrame functions only.

Texts and templates become lower-case words and shingles of ``SHINGLE`` of them (a template of fewer words is one
shingle of its own size). Templates are grouped by their number m of shingles. For each group a text has windows of 2m shingles, one every m,
so a notice lies whole in one of them, which then has a similarity to the template of at least a half. With ``BANDS``
bands of one value each, window and template collide in some band with a probability of 1 - 0.5^16, over 0.9999;
for a notice that keeps 0.8 of its shingles it is over 0.999.

A band's value of a window equals that of a template only if the window holds the template's least shingle of
that band. So windows are first drawn around those few shingles and only their signatures are made, which finds
the same collisions as signatures of all windows. A retrieved template is verified exactly: the share of its
distinct shingles that the window holds is at least ``LEAST``.

Templates are a given, fixed set: they and their signatures are small and broadcast.

Defined results: NULL and empty texts hold nothing; of several windows that verify, the best share counts, then the
first. Rows that repeat id and text count once; a NULL id is kept as such.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
BANDS = 16
LEAST = 0.8
NOT_WORDS = r"[^\p{L}\p{N}]+"

# Fixed: license notices as they are commonly written, and the paragraphs of short licenses and of file headers, one
# template each, so that an excerpt is found by the paragraphs that it holds.
NOTICES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "mit": "Released under the MIT License.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "all-rights-reserved": "All rights reserved.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted "
           "provided that the following conditions are met",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "mit/permission": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
                      "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
                      "including without limitation the rights to use, copy, modify, merge, publish, distribute, "
                      "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
                      "furnished to do so, subject to the following conditions:",
    "mit/warranty": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT "
                    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN "
                    "NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
                    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
                    "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "isc/permission": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
                      "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
                      "copies.",
    "bsd-3/endorsement": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                         "or promote products derived from this software without specific prior written permission.",
    "bsd/warranty": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
                    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
                    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR "
                    "ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
                    "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
                    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF "
                    "ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "apache-2.0/header": "you may not use this file except in compliance with the License. You may obtain a copy of the "
                         "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                         "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                         "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                         "language governing permissions and limitations under the License.",
    "gpl-3.0/header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                      "General Public License as published by the Free Software Foundation, either version 3 of the "
                      "License, or (at your option) any later version.",
    "gpl/warranty": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
                    "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public "
                    "License for more details.",
}


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NOT_WORDS), lambda word: word != "")


def _shingles(words: Column, first: Column, count: Column, size: Column) -> Column:
    """``count`` shingles from the zero-based place ``first`` on."""
    return F.transform(F.sequence(F.lit(1), count),
                       lambda at: F.array_join(F.slice(words, first + at, size), " "))


def _signature(shingles: Column) -> Column:
    """One value for each band: the least of the shingles' hashes under that band's seed."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.array_min(
        F.transform(shingles, lambda shingle: F.xxhash64(shingle, band))))


def _templates(spark, notices: dict[str, str]) -> DataFrame:
    """``license, s, m, shingles, signature, draws``: the draws are hashes of each band's least shingle."""
    raw = spark.createDataFrame(sorted(notices.items()), "license string, text string")
    sized = raw.select("license", _words(F.col("text")).alias("words")).where(F.size("words") > 0).select(
        "license", "words", F.least(F.lit(SHINGLE), F.size("words")).alias("s")).withColumn(
        "m", F.size("words") - F.col("s") + 1)
    cut = sized.withColumn("shingles", _shingles(F.col("words"), F.lit(0), F.col("m"), F.col("s")))
    least = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda band: F.array_min(F.transform(
        F.col("shingles"), lambda one: F.struct(F.xxhash64(one, band).alias("h"), one.alias("one"))))["one"])
    return cut.select("license", "s", "m", F.array_distinct("shingles").alias("shingles"),
                      _signature(F.col("shingles")).alias("signature"),
                      F.transform(F.array_distinct(least), lambda one: F.xxhash64(F.split(one, " "))).alias("draws"))


def _hits(size: int, wanted: list[int]) -> Column:
    """``(at, h)`` of the shingles of ``size`` words whose hash is wanted."""
    hashed = F.transform(F.sequence(F.lit(0), F.size("words") - size), lambda at: F.struct(
        at.alias("at"), F.xxhash64(F.slice("words", at + 1, size)).alias("h")))
    return F.when(F.size("words") >= size, F.filter(hashed, lambda hit: hit["h"].isin(wanted)))


def _windows(size: int, count: int, wanted: list[int]) -> Column:
    """The windows of 2 ``count`` shingles, one every ``count``, that hold a wanted shingle."""
    own = F.filter(f"hits{size}", lambda hit: hit["h"].isin(wanted))
    starts = F.flatten(F.transform(own, lambda hit: F.array(
        hit["at"] - hit["at"] % count, F.greatest(F.lit(0), hit["at"] - hit["at"] % count - count))))
    drawn = F.transform(F.array_distinct(starts), lambda at: F.struct(
        F.lit(size).alias("s"), F.lit(count).alias("m"), at.alias("at")))
    return F.coalesce(drawn, F.array().cast("array<struct<s:int,m:int,at:int>>"))


def licenses(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
             notices: dict[str, str] | None = None) -> DataFrame:
    """``doc_id, license, share, word_at``: the templates that each document holds, and where the first shingle is."""
    templates = _templates(docs.sparkSession, notices or NOTICES)
    draws: dict[int, dict[int, set[int]]] = {}
    for row in templates.select("s", "m", "draws").collect():
        draws.setdefault(row["s"], {}).setdefault(row["m"], set()).update(row["draws"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                       _words(F.col(text)).alias("words"))
    for size, groups in draws.items():
        rows = rows.withColumn(f"hits{size}", _hits(size, sorted(set().union(*groups.values()))))
    windows = [_windows(size, count, sorted(values)) for size, groups in draws.items() for count, values in groups.items()]
    drawn = rows.select("doc_id", "text_hash", "words", F.explode(F.concat(*windows)).alias("w"))
    cut = drawn.select("doc_id", "text_hash", "w.*", F.least(
        2 * F.col("w")["m"], F.size("words") - F.col("w")["s"] + 1 - F.col("w")["at"]).alias("n"), "words").select(
        "doc_id", "text_hash", "s", "m", "at",
        _shingles(F.col("words"), F.col("at"), F.col("n"), F.col("s")).alias("held"))
    bands = cut.select("*", F.posexplode(_signature(F.col("held"))).alias("band", "value"))
    signed = templates.select("license", "s", "m", "shingles", F.posexplode("signature").alias("band", "value"))
    met = bands.join(F.broadcast(signed), ["s", "m", "band", "value"])
    share = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    first = F.array_position(F.transform("held", lambda one: F.array_contains("shingles", one)), F.lit(True))
    verified = met.select("doc_id", "text_hash", "license", share.alias("share"),
                          (F.col("at") + first - 1).cast("long").alias("word_at")).where(F.col("share") >= LEAST)
    best = verified.groupBy("doc_id", "text_hash", "license").agg(
        F.max(F.struct("share", (-F.col("word_at")).alias("back"))).alias("best"))
    return best.select("doc_id", "license", F.col("best")["share"].alias("share"), (-F.col("best")["back"]).alias("word_at"))
