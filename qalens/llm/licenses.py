"""Licence scan: passages of texts compared with licence templates by Dice coefficient over word bigrams.

A passage is a line, a paragraph (lines between blank lines) or the whole text; a paragraph of one line and a text of
one paragraph are not repeated. Within longer passages, and across paragraphs, a notice is found as a window of words that begins and
ends with a bigram of the template (a window trimmed to these has the greater Dice) and is at most (2 - t) / t times as long as
it; of windows that overlap the one that shares most bigrams is kept, and a window within a passage reported for the same
licence isn't repeated. Text is normalised to lower case words of letters and digits. With A and B the
sets of word bigrams of passage and template, Dice is 2 |A and B| / (|A| + |B|). A value of ``threshold`` t needs |B| between
|A| t / (2 - t) and |A| (2 - t) / t, so these size bounds pick the candidate templates before any bigram is compared; a text in
which a template has fewer bigrams than the lower bound has no window for it.

Paragraphs of a licence are templates of their own; those that its versions share have the family's name (BSD, GPL).

Templates are a bounded parameter (they become literals of the plan). Texts that hold too few bigrams of every template go after one
pass over their words; what is shuffled after that are windows and places of units, by the row of their text, so neither common
words nor hot sources gather rows anywhere. Only DataFrame expressions are used.

Nulls: a null text has no passage; a null id is kept. Rows are scanned one by one, so repeated rows repeat their matches. Of
equally similar templates the first by name is reported.
"""

from __future__ import annotations

import re
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from qalens.llm.common import id_text, written

THRESHOLD = 0.8
#: What separates paragraphs.
PARAGRAPHS = r"\n[ \t\r]*\n\s*"

# The wording of public licence notices.
_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
          "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY "
          "CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE "
          "SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
              "\"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
              "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
              "the following conditions:")
_MIT_NOTICE = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_BSD_HEAD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
             "are met:")
_BSD_1 = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_2 = ("Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
          "documentation and/or other materials provided with the distribution.")
_BSD_3 = ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this "
          "software without specific prior written permission.")
_BSD_AS_IS = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
              "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT "
              "HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT "
              "LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
              "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF "
              "THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_ISC = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        "above copyright notice and this permission notice appear in all copies.")
_ISC_AS_IS = ("THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF "
              "MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
              "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
              "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_APACHE_1 = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may "
             "obtain a copy of the License at")
_APACHE_2 = "http://www.apache.org/licenses/LICENSE-2.0"
_APACHE_3 = ("Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
             "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
             "limitations under the License.")
_GPL_1 = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
          "the Free Software Foundation, either version 3 of the License, or (at your option) any later version.")
_GPL_2 = ("This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
          "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.")
_GPL_3 = "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."
TEMPLATES: tuple[tuple[str, str], ...] = (
    ("Apache-2.0", " ".join((_APACHE_1, _APACHE_2, _APACHE_3))),
    ("Apache-2.0", _APACHE_1),
    ("Apache-2.0", _APACHE_2),
    ("Apache-2.0", _APACHE_3),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD", _BSD_HEAD),
    ("BSD", _BSD_1),
    ("BSD", _BSD_2),
    ("BSD", _BSD_AS_IS),
    ("BSD-2-Clause", " ".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_AS_IS))),
    ("BSD-2-Clause", " ".join((_BSD_HEAD, _BSD_1, _BSD_2))),
    ("BSD-3-Clause", " ".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3, _BSD_AS_IS))),
    ("BSD-3-Clause", " ".join((_BSD_HEAD, _BSD_1, _BSD_2, _BSD_3))),
    ("BSD-3-Clause", _BSD_3),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("GPL", _GPL_2),
    ("GPL", _GPL_3),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0-or-later", " ".join((_GPL_1, _GPL_2, _GPL_3))),
    ("GPL-3.0-or-later", _GPL_1),
    ("ISC", " ".join((_ISC, _ISC_AS_IS))),
    ("ISC", _ISC),
    ("ISC", _ISC_AS_IS),
    ("MIT", " ".join((_MIT_GRANT, _MIT_NOTICE, _AS_IS))),
    ("MIT", _MIT_GRANT),
    ("MIT", _MIT_NOTICE),
    ("MIT", _AS_IS),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
)


def _words(text: str) -> list[str]:
    return re.sub(r"[^a-z0-9]+", " ", text.lower()).split()


def template_bigrams(text: str) -> list[tuple[str, str]]:
    """Distinct bigrams of a template, as ``passage_bigrams`` makes them of passages."""
    words = _words(text)
    return sorted(set(zip(words, words[1:])))


def _longs(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _likely(hashes: str, bigrams: dict[int, list[int]]) -> Column:
    """The hashes of any template's bigrams, and about one in 60 of the others (a filter of 65,536 bits)."""
    bits = [0] * 1024
    for h in {h for b in bigrams.values() for h in b}:
        bits[h & 1023] |= 1 << ((h >> 58) & 63)
    words = _longs([b - (1 << 64) if b >> 63 else b for b in bits])
    return F.filter(hashes, lambda h: F.getbit(F.get(words, h.bitwiseAND(F.lit(1023).cast("long")).cast("int")), F.shiftrightunsigned(h, 58).cast("int")) == 1)


def _split_words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda x: x != "")


def _hashes(words: Column) -> Column:
    """Hashed bigrams of two words or more, in order."""
    return F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1)))


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, worked out once however often the body uses it (as lambdas work out what they hold again)."""
    return F.get(F.transform(F.array(value), body), 0)


def passages(text: Column) -> Column:
    """Array of (unit, number, passage)."""
    def numbered(unit: str, parts: Column) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(unit).alias("unit"), i.alias("number"), p.alias("passage")))

    lines, paragraphs = F.split(text, r"\n"), F.split(text, PARAGRAPHS)
    several = F.filter(paragraphs, lambda p: p.contains("\n"))
    whole = F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.concat(numbered("line", lines), numbered("paragraph", several), numbered("text", whole))


class _Templates:
    """Templates by number: their names, hashed bigrams and size bounds at threshold ``t``, and the same as literals of a plan."""

    def __init__(self, spark: SparkSession, templates: tuple[tuple[str, str], ...], t: float):
        known = [(name, text, pairs) for name, text in sorted(templates) if (pairs := template_bigrams(text))]
        self.t, self.names = t, [name for name, _, _ in known]
        rows = [(i, a, b) for i, (_, _, pairs) in enumerate(known) for a, b in pairs]
        hashed = spark.createDataFrame(rows, "i int, a string, b string").groupBy("i").agg(F.collect_set(F.xxhash64("a", "b")).alias("h")).collect()
        self.bigrams = {r.i: r.h for r in hashed}  # the templates' own, as Spark hashes them
        self.need = {i: max(1, ceil(len(b) * t / (2 - t) - 1e-9)) for i, b in self.bigrams.items()}
        self.least = min(self.need.values(), default=1)
        words = [_words(text) for _, text, _ in known]
        self.table = F.array(*[
            F.struct(F.lit(i).alias("i"), F.lit(self.names[i]).alias("license"), F.lit(self.need[i]).alias("need"),
                     F.lit(int((len(words[i]) - 1) * (2 - t) / t + 1e-9)).alias("most"), F.xxhash64(*map(F.lit, words[i][:2])).alias("opening"),
                     _longs(self.bigrams[i]).alias("b")) for i in range(len(known))])


def license_matches(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """Passages of ``docs`` (doc_id, text) that reach ``threshold``: doc_id, unit, number (from 0), passage, license, dice.

    The number of a window is that of its first word in the text.
    """
    known = _Templates(docs.sparkSession, templates, threshold)
    if not known.names:
        return id_text(docs).where("false").select("doc_id", F.lit("").alias("unit"), F.lit(0).alias("number"), F.col("text").alias("passage"),
                                                   F.lit("").alias("license"), F.lit(0.0).alias("dice"))
    texts = written(_candidates(id_text(docs), known), "licence-texts")
    whole = written(_of_passages(texts, known), "licence-passages")
    windows = written(_apart(_windows(texts, known)), "licence-windows")
    return whole.drop("row").unionByName(_shown(texts, _uncovered(texts, whole, windows)))


def _candidates(docs: DataFrame, known: _Templates) -> DataFrame:
    """(row, doc_id, text, fit): texts that hold enough bigrams of some template, and the numbers of those templates.

    A passage's bigrams are bigrams of its text, so no other text has a match; the words of a text are hashed once here,
    and again only for these.
    """
    hashed = docs.select("*", F.explode(F.array(_split_words(F.col("text")))).alias("w"))
    hashed = hashed.withColumn("held", F.when(F.size("w") > known.least, F.array_distinct(_likely(_hashes(F.col("w")), known.bigrams))))
    # Generators between steps: each step sees only the rows that the one before left, and no filter on a step is pushed below it.
    some = hashed.select("doc_id", "text", F.explode(F.when(F.size("held") >= known.least, F.array("held"))).alias("held"))
    fit = F.transform(F.filter(known.table, lambda x: F.size(F.array_intersect(F.col("held"), x["b"])) >= x["need"]), lambda x: x["i"])
    fit = some.withColumn("fit", fit).select("doc_id", "text", F.explode(F.when(F.size("fit") > 0, F.array("fit"))).alias("fit"))
    return fit.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text", "fit")


def _of_passages(texts: DataFrame, known: _Templates) -> DataFrame:
    """(row, doc_id, unit, number, passage, license, dice): lines, paragraphs and texts that reach the threshold."""
    t, bigrams = known.t, known.bigrams
    split = texts.select("row", "doc_id", F.explode(passages(F.col("text"))).alias("p")).select("row", "doc_id", "p.*")
    split = split.select("*", F.explode(F.array(_split_words(F.col("passage")))).alias("w"))
    sets = split.withColumn("a", F.when(F.size("w") > known.least, F.array_distinct(_hashes(F.col("w"))))).withColumn("n", F.size("a")).drop("w")
    sets = sets.withColumn("held", _likely("a", bigrams))

    def against(i: int) -> Column:
        size = len(bigrams[i])
        shared = F.size(F.array_intersect("held", _longs(bigrams[i])))
        dice = 2.0 * shared / (F.col("n") + size)
        fits = F.col("n").between(size * t / (2 - t) - 1e-9, size * (2 - t) / t + 1e-9)  # else no overlap is enough
        return F.when(fits, F.struct(dice.alias("dice"), F.lit(-i).alias("rank")))

    best = F.when(F.size("held") >= known.least, F.array_max(F.array(*[against(i) for i in sorted(bigrams)])))
    found = sets.withColumn("best", best).select("row", "doc_id", "unit", "number", "passage", F.explode_outer(F.array("best")).alias("best"))
    return found.where(F.col("best.dice") >= t).select(
        "row", "doc_id", "unit", "number", "passage", F.get(F.array(*map(F.lit, known.names)), -F.col("best.rank")).alias("license"),
        F.col("best.dice").alias("dice"))


def _windows(texts: DataFrame, known: _Templates) -> DataFrame:
    """(row, common, dice, i, first, last, license): from each place where a window may begin, the one of the greatest Dice, if
    that reaches the threshold; common and dice are negative, so that the best sort first."""
    t = known.t
    hashed = texts.select("row", "fit", F.explode(F.array(_split_words(F.col("text")))).alias("w")) \
        .select("row", "fit", F.explode(F.array(_hashes(F.col("w")))).alias("h"))
    # What lambdas refer to comes out of generators: a projection would be merged into them and worked out for every element.
    hashed = hashed.select("row", "fit", F.explode(F.array(F.struct("h", F.array_distinct(_likely("h", known.bigrams)).alias("held")))).alias("s")) \
        .select("row", "fit", "s.*")
    at = F.filter(F.transform("h", lambda h, k: F.when(F.array_contains("held", h), k)), lambda k: k.isNotNull())

    def heads(x: Column) -> Column:
        # A window gains by every bigram of the template before it, so it begins with a run of them (or where the template does).
        def among(own: Column) -> Column:
            near = F.transform(own, lambda k, j: F.struct(k.alias("k"), F.get(own, j - 1).alias("before"), F.get(own, j + x["need"] - 1).alias("enough")))
            starts = F.filter(near, lambda s: (s["before"].isNull() | (s["before"] != s["k"] - 1) | (F.get(F.col("h"), s["k"]) == x["opening"])) &
                              (s["enough"] < s["k"] + x["most"]))
            return F.transform(starts, lambda s: F.struct(x["i"].alias("i"), s["k"].alias("first"), F.slice(F.col("h"), s["k"] + 1, x["most"]).alias("part")))

        return _let(F.filter(F.col("at"), lambda k: F.array_contains(x["b"], F.get(F.col("h"), k))), among)

    begun = hashed.select("row", "fit", "h", F.explode(F.array(at)).alias("at")).withColumn("heads", F.flatten(F.transform("fit", lambda i: _let(F.get(known.table, i), heads))))
    begun = begun.select("row", F.explode("heads").alias("head")).select("row", "head.*")
    begun = begun.select("row", "i", "first", "part", F.explode(F.array(F.get(known.table, F.col("i"))["b"])).alias("b"))

    def longer(s: Column, k: Column) -> Column:
        h = F.get("part", k)
        new = F.array_position("part", h) == k + 1
        n = s["n"] + new.cast("int")
        shared = s["shared"] + (new & F.array_contains("b", h)).cast("int")
        dice = 2.0 * shared / (n + F.size("b"))
        better = (dice > s["dice"]) | ((dice == s["dice"]) & F.array_contains("b", h))
        return F.struct(n.alias("n"), shared.alias("shared"), F.when(better, dice).otherwise(s["dice"]).alias("dice"),
                        F.when(better, shared).otherwise(s["common"]).alias("common"), F.when(better, k).otherwise(s["last"]).alias("last"))

    none = F.struct(F.lit(0).alias("n"), F.lit(0).alias("shared"), F.lit(0.0).alias("dice"), F.lit(0).alias("common"), F.lit(0).alias("last"))
    best = F.aggregate(F.sequence(F.lit(0), F.size("part") - 1), none, longer)
    found = begun.withColumn("best", best).select("row", "i", "first", F.explode(F.when(F.col("best.dice") >= t, F.array("best"))).alias("best"))
    return found.select("row", (-F.col("best.common")).alias("common"), (-F.col("best.dice")).alias("dice"), "i", "first",
                        (F.col("first") + F.col("best.last") + 1).alias("last"), F.get(F.array(*map(F.lit, known.names)), F.col("i")).alias("license"))


def _apart(windows: DataFrame) -> DataFrame:
    """Of windows that overlap, those that sort first: decided within groups of windows that no gap parts."""
    inside = Window.partitionBy("row").orderBy("first", "last")
    reach = F.max("last").over(inside.rowsBetween(Window.unboundedPreceding, -1))
    parted = windows.withColumn("gap", F.coalesce((F.col("first") > reach).cast("int"), F.lit(1)))
    parted = parted.withColumn("part", F.sum("gap").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    each = F.struct("common", "dice", "i", "first", "last", "license")
    found = parted.groupBy("row", "part").agg(F.array_sort(F.collect_list(each)).alias("found"))
    kind = "array<struct<common:int,dice:double,i:int,first:int,last:int,license:string>>"
    apart = F.aggregate("found", F.array().cast(kind), lambda kept, s: F.when(
        F.exists(kept, lambda o: (s["first"] <= o["last"]) & (o["first"] <= s["last"])), kept).otherwise(F.concat(kept, F.array(s))))
    return found.withColumn("found", F.col("found").cast(kind)).select("row", F.explode(apart).alias("s")) \
        .select("row", "s.first", "s.last", "s.license", (-F.col("s.dice")).alias("dice"))


def _uncovered(texts: DataFrame, whole: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows that lie in no passage reported for the same licence.

    Units of one kind follow each other, so the unit that a window begins in is the last one before it: both are sorted
    together, by text and kind.
    """
    def counted(unit: str, parts: Column, told: bool) -> Column:
        return F.transform(parts, lambda p, i: F.struct(F.lit(unit).alias("unit"), i.alias("place"), F.size(_split_words(p)).alias("n"),
                                                        (F.lit(told) | p.contains("\n")).alias("told")))

    units = F.concat(counted("line", F.split("text", r"\n"), True), counted("paragraph", F.split("text", PARAGRAPHS), False),
                     counted("text", F.array("text"), True))
    those = texts.join(windows.select("row").distinct(), "row", "left_semi").select("row", F.explode(units).alias("u")).select("row", "u.*")
    so_far = Window.partitionBy("row", "unit").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum("n").over(so_far).cast("int")
    number = F.when(F.col("told"), F.sum(F.col("told").cast("int")).over(so_far).cast("int") - 1)
    places = those.select("row", "unit", "place", (end - F.col("n")).alias("first"), F.struct(number.alias("number"), end.alias("end")).alias("in"),
                          F.lit(None).cast("int").alias("last"), F.lit(None).cast("string").alias("license"))
    kinds = F.explode(F.array(*map(F.lit, ("line", "paragraph", "text"))))
    begun = windows.select("row", kinds.alias("unit"), "first", "last", "license")
    both = places.unionByName(begun, allowMissingColumns=True)
    order = Window.partitionBy("row", "unit").orderBy("first", F.col("last").isNotNull(), "place").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("in", F.last("in", ignorenulls=True).over(order)).where(F.col("last") < F.col("in.end")) \
        .select("row", "unit", F.col("in.number").alias("number"), "license", "first")
    covered = held.join(whole, ["row", "unit", "number", "license"], "left_semi").select("row", "first").distinct()
    return windows.join(covered, ["row", "first"], "left_anti")


def _shown(texts: DataFrame, windows: DataFrame) -> DataFrame:
    """The windows with their passages, from the first letter of the first word to the last of the last."""
    lists = windows.groupBy("row").agg(F.collect_list(F.struct("first", "last", "license", "dice")).alias("found"))
    raw = F.regexp_extract_all("text", F.lit(r"[A-Za-z0-9]+[^A-Za-z0-9]*"), F.lit(0))
    words = texts.join(lists, "row").select("doc_id", "found", F.explode(F.array(F.struct(_split_words(F.col("text")).alias("w"), raw.alias("raw")))).alias("s"))
    raw = F.when(F.size("s.raw") == F.size("s.w"), F.col("s.raw")).otherwise(F.transform("s.w", lambda x: F.concat(x, F.lit(" "))))
    words = words.select("doc_id", "found", F.explode(F.array(raw)).alias("raw"))
    parts = F.transform("found", lambda s: F.struct(s.alias("s"), F.array_join(F.slice("raw", s["first"] + 1, s["last"] - s["first"] + 1), "").alias("passage")))
    return words.select("doc_id", F.explode(parts).alias("p")).select(
        "doc_id", F.lit("window").alias("unit"), F.col("p.s.first").alias("number"), F.regexp_replace("p.passage", r"[^A-Za-z0-9]+$", "").alias("passage"),
        F.col("p.s.license").alias("license"), F.col("p.s.dice").alias("dice"))
