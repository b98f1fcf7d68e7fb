"""Noise in text from scanned pages: what kind is in which line, and the repaired text.

1. Lines of every document are classified: a hard-wrapped document is a scan; its
   page numbers and running headers are furniture, and a break mark at the end of a
   line joins the word to the next line of running text.  Header-like lines are
   headers if they resemble the document's title or most of their words stand in
   titles (joined by word, also over glyph edits).
2. Skip-gram vectors of words are learned over all documents: the positive
   point-wise mutual information of a word with the words up to two places before
   and behind, the matrix that skip-gram training with negative samples factorises,
   kept sparse and exact as a Spark aggregation.
3. Rare words are linked to frequent ones that differ by plausible glyph edits (at
   most two), words that clean text has as well to those one edit away.  Every
   occurrence is then corrected in its own context: each candidate is scored by its
   frequency and by its vector at the words around, and the best one is taken; a
   word of clean text stays unless only the candidate fits there.
4. Furniture goes, words are joined and corrected, lines flow into paragraphs.
"""

from __future__ import annotations

import difflib
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarkaloom.plans.session import stage

RATIO, LEAST_COUNT = 5, 4
# what a word of clean text must be outdone by at the words around it, and by how many of them
MARGIN, WITNESSES = 6.0, 2
TITLES = 2
# documents whose tokens a Python worker holds at once
SLICE = 256

# Glyphs as misread, and what stood on the page (lower case).
GLYPHS = (
    ("c", "e"), ("e", "c"), ("f", "t"), ("t", "f"), ("u", "n"), ("n", "u"), ("i", "l"), ("l", "i"), ("b", "h"), ("h", "b"), ("q", "g"),
    ("cl", "d"), ("d", "cl"), ("rn", "m"), ("m", "rn"), ("vv", "w"), ("ii", "u"), ("ii", "ü"), ("h", "li"), ("li", "h"), ("0", "o"), ("1", "l"), ("1", "i"), ("5", "s"), ("6", "b"), ("8", "b"), ("9", "g"),
)
_BREAK = "-‐‑¬­"
_TOKEN = regex.compile(r"[\p{L}\p{M}\p{N}]+(?:['’][\p{L}\p{M}\p{N}]+)*")
_PAGE = regex.compile(r"^\W*(?:[Pp][aeo]?g[ec]?\.?\s*)?\W{0,4}([\dOoIlSBi]{1,4}|[ivxlc1]{1,8})\W{0,4}$")
_ROMAN = regex.compile(r"^[cx1]{0,4}(?:[xl1]{0,4})(?:ix|iv|v?[i1l]{0,3})$")
_ENDS = regex.compile(r"[.?!।॥:]['\"”’»)\]\s]*$")
_EDGE_NUMBER = regex.compile(r"^\W*(?:[\dOolIS]{1,4}|[ivxlc]{1,8})(?=\W)\W+(?=[\p{L}\d].*\p{L})|\W+(?:[\dOolIS]{0,3}\d[\dOolIS]{0,3}|(?<=\s\W*)[ivxlc]{1,8})\W*$")
_SHAPE = str.maketrans("0156", "olsb")
_SMALL = {"from", "with", "upon", "into", "über", "von", "vom", "zur", "zum", "dans", "pour", "avec"}
_DIGIT = regex.compile(r"\d")
_ROMAN_EDGE = regex.compile(r"\s[ivxlc]+$|^[ivxlc]+\s")
_NO_HEADER = regex.compile(r"[.?!।;:|>*,]")
_VERSE = regex.compile(r"^\W*(?:verse\W+\d+|[IVXLC]+\W\d+|\d+\W\d+)\W*$", regex.I)


def _folded(word: str) -> str:
    return word.lower().translate(_SHAPE)


class Page:
    """Classifies the lines of one document."""

    @staticmethod
    def header_words(line: str) -> list[str] | None:
        """The words of a header-like line: in capitals, or in title case beside a page number."""
        body = _EDGE_NUMBER.sub("", line)
        letters = [c for c in body if c.isalpha()]
        upper = sum(map(str.isupper, letters)) > 0.7 * len(letters)
        # a heading in title case alone is no running header: that has the page number
        # beside it or stands in capitals
        numbered = body != line and _DIGIT.search(line) or _ROMAN_EDGE.search(line)
        if not letters or not (upper or numbered) or _NO_HEADER.search(body):
            return None
        words = _TOKEN.findall(body)
        if not words:
            return None
        if not upper:
            titled = all(w[0].isupper() or not w[0].isalpha() or len(w) < 4 or w.lower() in _SMALL for w in words) and (words[0][0].isupper() or words[0][0].isdigit())
            if not titled:
                return None
        return words

    def candidates(self, text: str, title: str | None) -> Iterator[tuple[int, list[str], bool]]:
        """Header-like lines: number, words, and whether the line resembles the title."""
        for i, line in enumerate(text.split("\n")):
            s = line.strip()
            if s and (words := self.header_words(s)):
                body = _EDGE_NUMBER.sub("", s)
                like = bool(title) and difflib.SequenceMatcher(None, _folded(body), _folded(title), autojunk=False).ratio() >= 0.8
                yield i, [_folded(w) for w in words], like

    @staticmethod
    def is_wrapped(lines: list[str]) -> bool:
        """Do sentences go on from line to line, at about one width?"""
        lines = [x for x in lines if x]
        on = []
        for x, y in zip(lines, lines[1:], strict=False):
            first = unicodedata.category(y[0])
            if len(x) >= 20 and not _ENDS.search(x) and (first in ("Ll", "Lo") or y[0] in "0156"):
                on.append(len(x))
        long = sum(len(x) >= 20 for x in lines)
        if len(on) < 2 or len(on) < 0.3 * (long - 1):
            return False
        on.sort()
        mid = on[len(on) // 2]
        near = sum(0.75 * mid <= n <= 1.3 * mid for n in on)
        return mid <= 110 and near >= 0.8 * len(on)

    def kinds(self, text: str, headers: set[int]) -> tuple[bool, list[str]]:
        """Is it a scan, and per line: text, header, pageno, verse, blank or other."""
        lines = text.split("\n")
        out = []
        rough = []
        for i, x in enumerate(lines):
            s = x.strip()
            if not s:
                out.append("blank")
            elif (m := _PAGE.match(s)) and (any(c.isdigit() for c in m[1]) or _ROMAN.match(m[1])):
                out.append("pageno")
            elif _VERSE.match(s):
                out.append("verse")
            elif i in headers:
                out.append("header")
            else:
                out.append("text")
                rough.append(s)
        scan = self.is_wrapped(rough)
        if scan:
            wide = sorted(len(x) for x in rough)[int(0.6 * (len(rough) - 1))] * 1.25 + 6
            out = ["other" if k == "text" and (len(x.rstrip()) > wide or regex.search(r"::| \| | > ", x)) else k for k, x in zip(out, lines, strict=True)]
        return scan, out

    def document(self, text: str, headers: set[int]) -> tuple[bool, list[str], list[int], list[tuple[int, int, str, int]]]:
        """Scan?, kinds, lines that end in a break mark, and tokens (line of the first
        part, line of the last part, word, letters of it in the first part)."""
        scan, kinds = self.kinds(text, headers)
        lines = text.split("\n")
        run = [i for i, k in enumerate(kinds) if k in ("text", "other")] if not scan else [i for i, k in enumerate(kinds) if k == "text"]
        breaks, tokens, carry = [], [], None
        for n, i in enumerate(run):
            line = lines[i].rstrip()
            found = _TOKEN.findall(line)
            if carry is not None and found:
                first, at = carry
                tokens.append((at, i, first + found[0], len(first)))
                found = found[1:]
            carry = None
            nxt = lines[run[n + 1]].lstrip() if n + 1 < len(run) else ""
            if scan and found and len(line) > 1 and line[-1] in _BREAK and (line[-2].isalpha() or unicodedata.category(line[-2])[0] == "M") and nxt and (nxt[0].islower() or nxt[0] in "156089" or unicodedata.category(nxt[0]) == "Lo"):
                breaks.append(i)
                carry = (found.pop(), i)
            tokens += [(i, i, w, len(w)) for w in found]
        if carry is not None:
            tokens.append((carry[1], carry[1], carry[0], len(carry[0])))
        return scan, kinds, breaks, [t for t in tokens if any(c.isalpha() for c in t[2])]


_TOKENS = pa.struct([("line", pa.int64()), ("last", pa.int64()), ("cut", pa.int64()), ("word", pa.string()), ("near", pa.string())])
_OUT = "doc_id bigint, scan boolean, kinds array<string>, breaks array<bigint>, tokens array<struct<line:bigint,last:bigint,cut:bigint,word:string,near:string>>"


def _doc_rows(docs: DataFrame, key: str) -> DataFrame:
    return docs.where("text is not null").select(F.col(key).cast("bigint").alias("doc_id"), "text", "title")


def header_lines(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, headers``: the numbers of the header lines of each document that has any.

    A header-like line counts if it resembles the document's own title or at least 0.6 of
    its words stand in ``TITLES`` titles or more, as they are or as misreadings.
    """

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = Page()
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for doc, text, title in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                for i, words, like in page.candidates(text, title):
                    for column, x in zip(rows, (doc, i, words, like), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.list_(pa.string()), pa.bool_()), strict=True)], ["doc_id", "line_no", "words", "is_like"])

    found = stage(_doc_rows(docs, key).mapInArrow(lines, "doc_id bigint, line_no bigint, words array<string>, is_like boolean"), "candidates")
    in_title = F.explode(F.array_distinct(F.split(F.lower("title"), r"(?U)[^\p{L}\p{M}]+")))
    titles = docs.select(in_title.alias("w")).where("w <> ''").select(F.translate("w", "0156", "olsb").alias("known")).groupBy("known").agg(F.count("*").alias("n")).where(F.col("n") >= TITLES)
    words = found.select(F.explode("words").alias("word")).distinct()
    known = words.select("word", F.explode(_readings("word")).alias("known")).join(titles, "known").select("word").distinct()
    each = found.select("doc_id", "line_no", "is_like", F.explode("words").alias("word")).join(known.withColumn("known", F.lit(True)), "word", "left")
    sums = each.groupBy("doc_id", "line_no").agg(F.max("is_like").alias("is_like"), F.count("*").alias("n"), F.count("known").alias("n_known"))
    kept = sums.where(F.col("is_like") | (10 * F.col("n_known") >= 6 * F.col("n")))
    return kept.groupBy("doc_id").agg(F.collect_set("line_no").alias("headers"))


def read_pages(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, scan, kinds, breaks, tokens`` of every document with a text; a token
    carries the words around it."""

    def pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page = Page()
        for batch in (b.slice(i, SLICE) for b in batches for i in range(0, b.num_rows, SLICE)):
            docs_, texts, headers = (batch.column(i).to_pylist() for i in range(3))
            scans, kinds, breaks, ends = [], [], [], [0]
            flat: tuple[list, ...] = ([], [], [], [], [])
            for text, header in zip(texts, headers, strict=True):
                scan, kind, brk, tokens = page.document(text, set(header or ()))
                low = ["_", "_", *(t[2].lower() for t in tokens), "_", "_"]
                for j, t in enumerate(tokens):
                    for column, x in zip(flat, (t[0], t[1], t[3], low[j + 2], f"{low[j]} {low[j + 1]} {low[j + 3]} {low[j + 4]}"), strict=True):
                        column.append(x)
                scans.append(scan)
                kinds.append(kind)
                breaks.append(brk)
                ends.append(len(flat[0]))
            fields = [pa.array(c, f.type) for c, f in zip(flat, _TOKENS, strict=True)]
            tok = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_TOKENS)))
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(scans, pa.bool_()), pa.array(kinds, pa.list_(pa.string())), pa.array(breaks, pa.list_(pa.int64())), tok], ["doc_id", "scan", "kinds", "breaks", "tokens"])

    rows = _doc_rows(docs, key).join(header_lines(docs, key), "doc_id", "left").select("doc_id", "text", "headers")
    return rows.mapInArrow(pages, _OUT)


def _near(c: str) -> Column:
    """The words around a token, each with its place."""
    return F.filter(F.transform(F.split(c, " "), lambda w, i: F.concat(i.cast("string"), w)), lambda w: ~w.endswith("_"))


def _once(word: str) -> set[str]:
    return {word[:i] + b + word[i + len(a) :] for a, b in GLYPHS for i in range(len(word)) if word.startswith(a, i)}


def glyph_variants(word: str, edits: int = 2) -> set[str]:
    """Words that this one may be a misreading of: one or two glyph edits."""
    out = last = _once(word)
    for _ in range(edits - 1):
        last = {v for w in last for v in _once(w)}
        out = out | last
    return out - {word}


@F.pandas_udf(T.ArrayType(T.StringType()))
def _variants(words: pd.Series, edits: pd.Series) -> pd.Series:
    return pd.Series([sorted(v for v in glyph_variants(w, int(k)) if not any(c.isdigit() for c in v)) for w, k in zip(words, edits, strict=True)], dtype=object)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _readings(words: pd.Series) -> pd.Series:
    return words.map(lambda w: [w, *sorted(glyph_variants(w))])


def links(counts: DataFrame) -> DataFrame:
    """``word, cand, n_cand, real``: what each word of scans may stand for.

    ``counts``: ``word, n, n_scan``.  Words that hardly occur outside scans (``real`` is false)
    are linked over two edits to words ``RATIO`` times as frequent, or to any if they hold a
    digit; words of clean text over one edit to any frequent word.
    """
    digit = F.col("word").rlike("[0-9]")
    real = F.col("n_scan") < 0.9 * F.col("n")
    asked = counts.where((F.col("n_scan") > 0) & (F.length("word") > 1) & F.col("word").rlike(r"\p{L}")).select("word", "n", digit.alias("digit"), real.alias("real"))
    asked = asked.where(~F.col("real") | ~F.col("digit") & (F.length("word") > 3))
    near = asked.select("*", F.explode(_variants("word", F.when(F.col("real"), 1).otherwise(2))).alias("cand")).join(counts.select(F.col("word").alias("cand"), F.col("n").alias("n_cand")), "cand")
    enough = F.when(F.col("digit"), F.col("n_cand") >= 1).when(F.col("real"), F.col("n_cand") >= LEAST_COUNT).otherwise((F.col("n_cand") >= RATIO * F.col("n")) & (F.col("n_cand") >= LEAST_COUNT))
    near = near.where(enough).select("word", "cand", "n_cand", "real")
    # what is itself a misreading corrects nothing
    return near.join(near.where("not real").select(F.col("word").alias("cand")).distinct(), "cand", "left_anti").select("word", "cand", "n_cand", "real")


def corrections(pages: DataFrame, use_vectors: bool = True) -> DataFrame:
    """``doc_id, at, line, last, cut, word, fix``: every misread occurrence (token number ``at``) in
    a scan and the word it stands for.

    The score of a candidate is the logarithm of its frequency plus what its skip-gram vector
    has at the words around the occurrence.  ``use_vectors=False`` leaves the vectors out, to
    measure what they decide.
    """
    tokens = pages.select("doc_id", "scan", F.posexplode("tokens").alias("at", "t")).select("doc_id", "scan", "at", "t.*")
    counts = stage(tokens.groupBy("word").agg(F.count("*").alias("n"), F.count_if("scan").alias("n_scan")), "words")
    near = stage(links(counts), "links")
    held = tokens.where("scan").join(near.select("word").distinct(), "word", "left_semi")
    held = stage(held.drop("scan"), "held")
    # explicit skip-gram vectors of the candidates, and of words of clean text by clean text
    own = near.where("real").select("word").distinct()
    asked = near.select(F.col("cand").alias("word"), F.lit(True).alias("scans")).union(own.select("word", F.lit(False).alias("scans"))).distinct()
    pairs = tokens.join(asked, "word").where(F.col("scans") | ~F.col("scan")).select("word", "scans", F.explode(_near("near")).alias("c"))
    pairs = stage(pairs.groupBy("word", "scans", "c").agg(F.count("*").alias("n")), "pairs")
    # a word is the context of as many words, per place, as it occurs (but at the edges)
    by_context = counts.select(F.col("word").alias("w"), F.col("n").alias("nc"))
    total = counts.agg(F.sum("n")).first()[0] or 1
    pmi = F.log(F.col("n") * float(total) / (F.col("nw") * F.col("nc")))
    sums = pairs.groupBy("word", "scans").agg((F.sum("n") / 4).alias("nw"))
    vectors = pairs.withColumn("w", F.expr("substring(c, 2)")).join(by_context, "w").join(sums, ["word", "scans"]).select(F.col("word").alias("cand"), "scans", "c", pmi.alias("x")).where("x > 0")
    vectors = stage(vectors if use_vectors else vectors.limit(0), "vectors")
    # every occurrence and candidate, the word itself among them if it is one
    itself = own.join(counts, "word").select("word", F.col("word").alias("cand"), (F.col("n") - F.col("n_scan")).alias("n_cand"), F.lit(True).alias("real"))
    cands = near.withColumn("scans", F.lit(True)).unionByName(itself.withColumn("scans", F.lit(False)))
    around = held.select("doc_id", "at", "word", F.explode(_near("near")).alias("c")).join(cands, "word").join(vectors, ["cand", "scans", "c"])
    fits = around.groupBy("doc_id", "at", "cand", "scans").agg(F.sum("x").alias("fit"), F.count("*").alias("witnesses"))
    scored = held.select("doc_id", "at", "word").distinct().join(cands, "word").join(fits, ["doc_id", "at", "cand", "scans"], "left")
    scored = scored.withColumns({"fit": F.coalesce("fit", F.lit(0.0)), "witnesses": F.coalesce("witnesses", F.lit(0))})
    score = F.struct(F.log(1 + F.col("n_cand")) + F.col("fit"), F.col("cand"))
    mine = lambda c: F.when(F.col("scans"), c)
    best = scored.groupBy("doc_id", "at").agg(
        F.max_by(mine(F.struct("cand", "fit", "witnesses")), mine(score)).alias("b"), F.max(F.when(~F.col("scans"), F.col("fit"))).alias("own"), F.max("real").alias("real")
    )
    sure = ~F.col("real") | (F.col("own") == 0) & (F.col("b.fit") >= MARGIN) & (F.col("b.witnesses") >= WITNESSES)
    best = best.where(sure).select("doc_id", "at", F.col("b.cand").alias("fix"))
    return held.drop("near").join(best, ["doc_id", "at"])


def line_noise(pages: DataFrame, fixes: DataFrame) -> DataFrame:
    """``doc_id, line_no, noise_kind`` of every noisy line of a scan.

    ``fixes``: the misread occurrences.  Null and empty texts have no lines; a repeated
    document repeats its rows once.
    """
    scans = pages.where("scan")
    furniture = scans.select("doc_id", F.posexplode("kinds").alias("line_no", "noise_kind")).where("noise_kind in ('header', 'pageno')")
    hyphens = scans.select("doc_id", F.explode("breaks").alias("line_no"), F.lit("hyphen").alias("noise_kind"))
    # a word over two lines is misread where it first differs from its correction
    at = F.when(F.expr("left(word, cut) = left(fix, cut)"), F.col("last")).otherwise(F.col("line"))
    chars = fixes.select("doc_id", at.alias("line_no"), F.lit("char").alias("noise_kind"))
    return furniture.withColumn("line_no", F.col("line_no").cast("bigint")).unionByName(hyphens).unionByName(chars).distinct()


def _match_case(fix: str, word: str) -> str:
    return fix.capitalize() if word[:1].isupper() else fix


def reflow(text: str, kinds: list[str], breaks: list[int], fixes: dict[str, str], compounds: set[str]) -> str:
    """Running text in paragraphs: furniture out, words joined and corrected."""
    out: list[str] = []
    glue = ""
    lines = text.split("\n")
    widths = sorted(len(x.strip()) for x, k in zip(lines, kinds, strict=True) if k == "text")
    short = 0.8 * widths[len(widths) * 3 // 4] if widths else 0
    for i, (line, kind) in enumerate(zip(lines, kinds, strict=True)):
        if kind in ("header", "pageno"):
            continue
        if kind == "blank":
            out.append("\n\n")
            glue = ""
            continue
        s = line.strip()
        if kind != "text":
            out.append(f"\n{s}\n")
            glue = ""
            continue
        if out and not out[-1].endswith("\n"):
            out.append(glue)
        out.append(s)
        # a short line that ends a sentence ends its paragraph
        glue = "\n\n" if _ENDS.search(s) and len(s) < short else " "
        if i in breaks:
            nxt = next((lines[j].lstrip() for j in range(i + 1, len(lines)) if kinds[j] == "text"), "")
            left, right = regex.search(r"[\p{L}\p{M}\p{N}]*(?=.$)", s)[0], regex.match(r"[\p{L}\p{M}\p{N}]*", nxt)[0]
            out[-1] = s if f"{left}-{right}".lower() in compounds else s[:-1]
            glue = ""
    joined = "".join(out)
    fixed = _TOKEN.sub(lambda m: _match_case(fixes[m[0].lower()], m[0]) if m[0].lower() in fixes else m[0], joined)
    return regex.sub(r"\n{3,}", "\n\n", fixed).strip()


def repaired(docs: DataFrame, pages: DataFrame, fixes: DataFrame, key: str = "doc_id") -> DataFrame:
    """``doc_id, text, n_fixes`` of every scan as continuous paragraphs."""
    scans = pages.where("scan")
    # in one document a word gets the fix of most of its occurrences there
    most = fixes.groupBy("doc_id", "word", "fix").agg(F.count("*").alias("n")).groupBy("doc_id", "word").agg(F.max_by("fix", F.struct("n", "fix")).alias("fix"))
    own = most.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "fix"))).alias("fixes"))
    d = docs.select(F.col(key).cast("bigint").alias("doc_id"), "text")
    # compounds written with a hyphen inside some line
    inside = d.select(F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\p{L}+-\p{L}+)"), F.lit(1)))).alias("compound")).groupBy("compound").agg(F.count("*").alias("n")).where("n > 1")
    breaks = scans.where(F.size("breaks") > 0).join(d, "doc_id")
    pieces = breaks.select("doc_id", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)(\p{L}+[-‐¬­]\n\p{L}+)"), F.lit(1))).alias("p")).select("doc_id", F.regexp_replace("p", r"[-‐¬­]\n", "-").alias("compound"))
    kept = pieces.join(inside, "compound", "left_semi").groupBy("doc_id").agg(F.collect_set("compound").alias("compounds"))
    j = scans.select("doc_id", "kinds", "breaks").join(d, "doc_id").join(own, "doc_id", "left").join(kept, "doc_id", "left")

    def flow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                fix = dict(r.fixes) if r.fixes is not None else {}
                comp = set(r.compounds) if r.compounds is not None else set()
                rows.append((r.doc_id, reflow(r.text, list(r.kinds), list(r.breaks), fix, comp), len(fix)))
            yield pd.DataFrame(rows, columns=["doc_id", "text", "n_fixes"])

    return j.mapInPandas(flow, "doc_id bigint, text string, n_fixes bigint")
