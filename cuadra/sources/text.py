"""Delimited and fixed-width text extracts.

A landing folder is listed once (``Landing``); every template is a regular
expression over the file paths of that listing, which Spark applies to the files
before it opens any, and which recovers the template's values (period, bank code,
...).  Millions of small files come packed (``Bundle``).  Files are read line by line with Spark's text source, so a file larger than a
split is read by several tasks.  The header of a file is its line at the least
(block start, row); header lines are removed by value.  Each line is parsed by the
layout that is valid at its file's date, all layouts in one scan; a line that no
layout can take is kept aside with its file, place and reason.  All of it is
DataFrame operations (no per-file driver loop).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cuadra.specs import RawSetting, RawSpec

FILE = "_file"
LINE = "value"

# Template tokens and what they match.
TOKENS = {
    "YYYY": ("[0-9][0-9][0-9][0-9]", r"(\d{4})"),
    "MM": ("[0-9][0-9]", r"(\d{2})"),
    "DD": ("[0-9][0-9]", r"(\d{2})"),
    "Cod_Banco": ("*", r"([^/]+?)"),
    "NUM": ("*", r"([^/]+?)"),
}
_TOKEN = re.compile(r"\{\{(\w+)\}\}")


def template_glob(template: str, params: Mapping[str, str] | None = None) -> str:
    """Glob for a template; given parameters are substituted, others match
    anything of their shape."""
    params = params or {}

    def sub(m: re.Match) -> str:
        name = m.group(1)
        if name in params:
            return str(params[name])
        return TOKENS.get(name, ("*", ""))[0]
    return _TOKEN.sub(sub, template)


def template_regex(template: str, params: Mapping[str, str] | None = None) -> tuple[str, list[str]]:
    """Regular expression over a file path, and the token of each group.
    A token used twice must repeat the same value (back-reference); a given
    parameter must be that value."""
    params = params or {}
    # local file paths come back with one slash after the scheme or with three
    template = re.sub(r"^file:/+", "/", template)
    names: list[str] = []
    out, pos = [], 0
    for m in _TOKEN.finditer(template):
        out.append(re.escape(template[pos:m.start()]).replace("\\*", "[^/]*"))
        name = m.group(1)
        if name in names:
            out.append(f"\\{names.index(name) + 1}")
        else:
            names.append(name)
            # a wildcard in a given value matches within one path segment
            out.append("(" + re.escape(str(params[name])).replace("\\*", "[^/]*") + ")" if name in params
                       else TOKENS.get(name, ("*", r"([^/]+?)"))[1])
        pos = m.end()
    out.append(re.escape(template[pos:]).replace("\\*", "[^/]*"))
    return "".join(out) + "$", names


def listing(template: str, params: Mapping[str, str] | None = None) -> tuple[str, str]:
    """(folder to list recursively, file-name glob) for a template.

    Listing the fixed prefix recursively with a name filter is far cheaper
    than resolving a glob with wildcards in several path segments; the full
    template is then enforced by the path regular expression."""
    resolved = template_glob(template, params)
    parts = resolved.split("/")
    fixed = []
    for seg in parts[:-1]:
        if any(ch in seg for ch in "*?[{"):
            break
        fixed.append(seg)
    return "/".join(fixed) or ".", parts[-1]


class Landing:
    """A folder of raw extracts, listed once.

    Its relations hold the listing, so scans of several templates, kinds or months
    share it; files that land later are seen by a new ``Landing``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._held = spark, root.rstrip("/"), {}

    def relation(self, kind: str, encoding: str = "UTF-8") -> DataFrame:
        """Every file of the folder, by the text source or (paths only) ``binaryFile``."""
        key = (kind, encoding.upper().replace("-", ""))
        if key not in self._held:
            reader = self.spark.read.option("recursiveFileLookup", "true")
            if kind == "files":
                made = reader.format("binaryFile").load(self.root)
            elif key[1] == "UTF8":
                made = reader.text(self.root)
            else:
                # the text source only decodes UTF-8; the CSV source honours the encoding
                made = (reader.option("sep", "\u0000").option("quote", "").option("encoding", encoding)
                        .schema("value string").csv(self.root))
            self._held[key] = made
        return self._held[key]

    def path(self, template: str) -> str:
        return f"{self.root}/{template}"

    def lines(self, encoding: str, fits: Callable[[Column], Column], values: Callable[[Column], Column] | None = None) -> DataFrame:
        """(``_file``, ``_block``, ``_row``, ``value``) of every line of the files whose path
        ``fits``, and what ``values`` makes of the path as ``_values``."""
        path = F.col("_metadata.file_path")
        rows = self.relation("lines", encoding).where(fits(path)).select(
            path.alias(FILE), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"), F.col(LINE))
        return _once(rows, _values=values(F.col(FILE))) if values else rows

    def files(self) -> DataFrame:
        """path, length and modificationTime of every file; none is opened."""
        return self.relation("files").select("path", "length", "modificationTime")


class Bundle(Landing):
    """A folder of raw extracts packed into Parquet, for millions of small files: neither a
    disk block nor an entry of the driver's listing each.

    A record is a piece of a file, cut between lines: path (in the folder), start (its first
    byte in the file), length, modificationTime, content.  Lines have two more columns:
    ``_line``, their number in the file from 0 (null beyond its first piece), and, where
    every file is one piece, ``_header``, the file's first line."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root)
        self.pieces = spark.read.parquet(self.root)
        self.whole = self.pieces.where("start > 0").isEmpty()

    def path(self, template: str) -> str:
        return template

    def lines(self, encoding: str, fits: Callable[[Column], Column], values: Callable[[Column], Column] | None = None) -> DataFrame:
        content = F.col("content")
        text = content.cast("string") if encoding.upper().replace("-", "") == "UTF8" else F.decode(content, encoding)
        cut = F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")
        made = [values(F.col("path")).alias("_values")] if values else []
        pieces = self.pieces.where(fits(F.col("path"))).select(F.col("path").alias(FILE), F.col("start").alias("_block"), *made, cut.alias("_lines"))
        header = [F.get("_lines", F.lit(0)).alias("_header")] if self.whole else []
        rows = pieces.select(FILE, "_block", *(["_values"] if values else []), *header, F.posexplode("_lines").alias("_row", LINE))
        return rows.withColumn("_row", F.col("_row").cast("long")).withColumn("_line", F.when(F.col("_block") == 0, F.col("_row")))

    def files(self) -> DataFrame:
        if self.whole:
            return self.pieces.select("path", "length", "modificationTime")
        return self.pieces.groupBy("path").agg(F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, each computed once a row however often it is used: the
    optimizer does not copy a generator's values into the filters and columns above it."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def _values(path: Column, pattern: str, names: Sequence[str]) -> Column:
    """The template's values in a path, as an array."""
    return F.split(F.regexp_replace(path, ".*?" + pattern, "\u0001".join(f"${i + 1}" for i in range(len(names)))), "\u0001")


def _tokens(path: Column, pattern: str, names: Sequence[str]) -> list[Column]:
    """The template's values from a path."""
    values = _values(path, pattern, names)
    return [values.getItem(i).alias(n) for i, n in enumerate(names)]


def lines_of(landing: Landing, template: str, params: Mapping[str, str] | None = None,
             encoding: str = "UTF-8", periods: Sequence[str] | None = None) -> DataFrame:
    """Every line of every file of the landing folder that matches the template.

    ``periods``: only files of these months ('yyyy-MM-01').  Both conditions are on the
    path, so Spark applies them to the listing and opens no other file.
    Output: ``_file``, the template's values, ``_block`` (first byte of the split the
    line was read from), ``_row``, ``value``; ``_block``/``_row`` order a file's lines."""
    pattern, names = template_regex(landing.path(template), params)

    def fits(path: Column) -> Column:
        if periods is None:
            return path.rlike(pattern)
        found = {n: t for n, t in zip(names, _tokens(path, pattern, names))}
        return path.rlike(pattern) & F.concat(found["YYYY"], found["MM"]).isin([p[:7].replace("-", "") for p in periods])
    rows = landing.lines(encoding, fits, (lambda path: _values(path, pattern, names)) if names else None)
    more = [c for c in ("_header", "_line") if c in rows.columns]
    return rows.select(FILE, *[F.col("_values").getItem(i).alias(n) for i, n in enumerate(names)], "_block", "_row", LINE, *more)


def read_lines(spark: SparkSession, template: str, params: Mapping[str, str] | None = None,
               encoding: str = "UTF-8") -> DataFrame:
    """``lines_of`` for one template whose folder is listed for it alone."""
    folder, _ = listing(template, params)
    return lines_of(Landing(spark, folder), template[len(folder.rstrip("/")) + 1:] if template.startswith(folder) else template, params, encoding)


def file_lines(files: DataFrame, template: str, encoding: str = "UTF-8",
               params: Mapping[str, str] | None = None) -> DataFrame:
    """Numbered lines of whole files read with the ``binaryFile`` source
    (columns ``path`` and ``content``); works on batch and streaming reads.
    Output: ``_file``, the template values, ``_header``, ``_line``, ``value``."""
    pattern, names = template_regex(template, params)
    path = F.col("path")
    tokens = [F.regexp_extract(path, pattern, i + 1).alias(n) for i, n in enumerate(names)]
    text = F.decode(F.col("content"), encoding)
    split = F.split(F.regexp_replace(text, r"\r?\n$", ""), r"\r?\n").alias("_lines")
    per_file = files.where(path.rlike(pattern)).select(path.alias(FILE), *tokens, split)
    return per_file.select(FILE, *names, F.element_at("_lines", 1).alias("_header"),
                           F.posexplode("_lines").alias("_line", LINE))


def header_records(lines: DataFrame, fields: Sequence[str], sep: str = "\t",
                   keys: Sequence[str] = (FILE,)) -> DataFrame:
    """First line of each file, split into the header fields.

    A file's first line lies in its first block; one row a file and task reaches the
    shuffle.  Output: keys, ``_header`` (the raw line), one column per field."""
    if "_line" in lines.columns:
        first = lines.where(F.col("_line") == 0).select(*keys, F.col(LINE).alias("_header"))
    else:
        first = (lines.where(F.col("_block") == 0).groupBy(*keys)
                 .agg(F.min_by(F.col(LINE), F.col("_row")).alias("_header")))
    parts = F.split(F.col("_header"), re.escape(sep), -1)
    return first.select(*keys, "_header",
                        *[F.trim(parts.getItem(i)).alias(f) for i, f in enumerate(fields)])


def drop_header(lines: DataFrame, headers: DataFrame | None = None,
                keys: Sequence[str] = (FILE,)) -> DataFrame:
    """Remove every line equal to its file's header line (not only the first:
    a repeated header further down is dropped too).

    Lines and headers meet by file and line, so the lines of a large file are spread
    over the tasks; few headers are broadcast by the planner."""
    if "_header" in lines.columns:
        return lines.where(F.col(LINE) != F.col("_header")).drop("_header")
    hdr = headers.select(*keys, F.col("_header").alias(LINE))
    return lines.join(hdr, [*keys, LINE], "left_anti")


def row_shape_filter(lines: DataFrame, predicate: str | Column | None = None) -> DataFrame:
    """Keep lines of the expected shape; default: at least 4 characters and
    the first 3 are digits."""
    if predicate is None:
        predicate = (F.length(F.col(LINE)) >= 4) & F.substring(F.col(LINE), 1, 3).rlike("^[0-9]{3}$")
    elif isinstance(predicate, str):
        predicate = F.expr(predicate)
    return lines.where(predicate)


def split_fields(lines: DataFrame, setting: RawSetting, keep: Sequence[str] = ()) -> DataFrame:
    """Split each line into the setting's columns and cast to their types.

    Delimited mode splits on the literal separator; fixed-position mode
    (``widths``) cuts substrings.  Conversions use ``try_cast`` (a bad value
    becomes null for the rules to report)."""
    cols = []
    if setting.widths:
        pos = 1
        for (name, dtype), width in zip(setting.columns, setting.widths):
            cols.append(F.trim(F.substring(F.col(LINE), pos, width)).try_cast(dtype).alias(name))
            pos += width
    else:
        parts = F.split(F.col(LINE), re.escape(setting.sep), -1)
        for i, (name, dtype) in enumerate(setting.columns):
            field = parts.getItem(i)
            cols.append((field if dtype == "string" else F.trim(field).try_cast(dtype)).alias(name))
    return lines.select(*keep, *cols)


def inventory(landing: Landing, raws: Mapping[str, RawSpec]) -> DataFrame:
    """Every file of the landing folder that belongs to one of the extracts, empty files
    too: raw_name, ``_file``, the templates' values (null where a template has none),
    length, modified.  No file is opened."""
    patterns = {k: template_regex(landing.path(r.template)) for k, r in raws.items()}
    names = list(dict.fromkeys(n for _, found in patterns.values() for n in found))
    path, kind, values = F.col("path"), None, {n: F.lit(None).cast("string") for n in names}
    for k, (pattern, found) in patterns.items():
        fits = path.rlike(pattern)
        kind = F.when(fits, k) if kind is None else kind.when(fits, k)
        for n, token in zip(found, _tokens(path, pattern, found)):
            values[n] = F.when(fits, token).otherwise(values[n])
    return (landing.files().select(kind.alias("raw_name"), path.alias(FILE), *[v.alias(n) for n, v in values.items()], "length",
                         F.col("modificationTime").alias("modified")).where(F.col("raw_name").isNotNull()))


@dataclass
class Scan:
    """A scanned template.  data: ``_file``, the template's values and the layout's
    columns.  headers: one row a file, None for header-less layouts.  rejects: lines that
    could not be taken (``rejected``)."""

    data: DataFrame
    headers: DataFrame | None
    rejects: DataFrame


SETTING = "_setting"
REASON = "_reason"


def setting_of(raw: RawSpec, period: Column) -> Column:
    """Number of the one setting valid at ``period``; null if none or several are."""
    valid = [period.between(s.start, s.end) for s in raw.settings]
    n = reduce(lambda a, b: a + b, [v.cast("int") for v in valid])
    first = reduce(lambda a, b: F.coalesce(a, b), [F.when(v, i) for i, v in enumerate(valid)])
    return F.when(n == 1, first)


def by_layout(lines: DataFrame, raw: RawSpec, period: Column) -> DataFrame:
    """Lines with ``_setting`` (the layout of the file's date), ``_parts`` (the line cut by
    that layout) and ``_reason``: why it can't be taken (encoding, layout, fields), or null."""
    def parts(s: RawSetting) -> Column:
        if not s.widths:
            return F.split(F.col(LINE), re.escape(s.sep), -1)
        begins = [1 + sum(s.widths[:i]) for i in range(len(s.widths))]
        return F.array(*[F.trim(F.substring(F.col(LINE), b, w)) for b, w in zip(begins, s.widths)])

    def pick(make):
        out = None
        for i, s in enumerate(raw.settings):
            out = F.when(F.col(SETTING) == i, make(s)) if out is None else out.when(F.col(SETTING) == i, make(s))
        return out

    cut = _once(_once(_once(lines, _period=period), **{SETTING: setting_of(raw, F.col("_period"))}), _parts=pick(parts))
    # in a fixed-width line the last column must begin at least
    short = pick(lambda s: F.length(LINE) <= sum(s.widths[:-1]) if s.widths else F.size("_parts") != len(s.columns))
    reason = (F.when(~F.is_valid_utf8(F.col(LINE)), "encoding").when(F.col(SETTING).isNull(), "layout").when(short, "fields"))
    return _once(cut, **{REASON: reason})


def typed(cut: DataFrame, raw: RawSpec, keep: Sequence[str]) -> DataFrame:
    """The layouts' columns from ``_parts``, by name whatever their order, cast with
    ``try_cast``.  A column that a layout lacks is null for its files."""
    types: dict[str, str] = {}
    for s in raw.settings:
        for name, dtype in s.columns:
            if types.setdefault(name, dtype) != dtype:
                raise ValueError(f"{raw.name}.{name}: {types[name]} in one layout, {dtype} in another")
    out = []
    for name, dtype in types.items():
        at = [[n for n, _ in s.columns].index(name) if name in dict(s.columns) else None for s in raw.settings]
        if len(set(at)) == 1:
            field = F.col("_parts").getItem(at[0])
        else:
            field = reduce(lambda a, b: F.coalesce(a, b),
                           [F.when(F.col(SETTING) == i, F.col("_parts").getItem(k)) for i, k in enumerate(at) if k is not None])
        out.append((field if dtype == "string" else F.trim(field).try_cast(dtype)).alias(name))
    return cut.select(*keep, *out)


def rejected(cut: DataFrame, lines: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Rejected lines: ``_file``, the template's values, ``_block`` and ``_line`` (the line's
    number in that block, from 1; a file smaller than a split is one block), ``_reason`` and
    the line's bytes as read (base64)."""
    first = lines.groupBy(FILE, "_block").agg(F.min("_row").alias("_first"))
    bad = cut.where(F.col(REASON).isNotNull()).select(*keep, "_block", "_row", REASON, LINE)
    return bad.join(first, [FILE, "_block"]).select(
        *keep, "_block", (F.col("_row") - F.col("_first") + 1).alias("_line"), REASON,
        F.base64(F.col(LINE).cast("binary")).alias("content"))


def raw_lines(landing: Landing, raw: RawSpec, params: Mapping[str, str] | None = None,
              periods: Sequence[str] | None = None) -> DataFrame:
    """``lines_of`` a raw extract."""
    encodings = {s.encoding.upper().replace("-", "") for s in raw.settings}
    if len(encodings) > 1:
        raise ValueError(f"{raw.name}: layouts of several encodings need a template each")
    return lines_of(landing, raw.template, params, raw.settings[0].encoding, periods)


def scan_raw(landing: Landing, raw: RawSpec, params: Mapping[str, str] | None = None,
             period: Column | None = None, shape: str | Column | None = None,
             periods: Sequence[str] | None = None, observation: Observation | None = None) -> Scan:
    """Read every file of a raw extract's template, each by the layout of its own date.
    The arguments are those of ``lines_of`` and ``scan_lines``."""
    return scan_lines(raw_lines(landing, raw, params, periods), raw, period, shape, observation)


def scan_lines(lines: DataFrame, raw: RawSpec, period: Column | None = None, shape: str | Column | None = None,
               observation: Observation | None = None) -> Scan:
    """``Scan`` of lines in the form of ``lines_of``.

    ``period``: the files' date where the template has none.  ``shape``: lines that do
    not meet it are no rows of the extract (titles); they are not rejects either.
    ``observation``: receives n_lines and n_rejected once the data is computed."""
    _, names = template_regex(raw.template)
    date = period if period is not None else file_period()
    headers, body = None, lines
    fields = {s.header_fields for s in raw.settings}
    if fields != {None}:
        if len(fields) > 1:
            raise ValueError(f"{raw.name}: headers must be alike in all layouts")
        headers = header_records(lines, next(iter(fields)), raw.settings[0].header_sep, keys=[FILE, *names])
        body = drop_header(lines, headers, keys=[FILE])
    body = body.where(F.length(F.col(LINE)) > 0)
    if shape is not None:
        body = row_shape_filter(body, None if shape == "default" else shape)
    cut = by_layout(body, raw, date)
    keep = [FILE, *names]
    taken = cut if observation is None else cut.observe(
        observation, F.count(F.lit(1)).alias("n_lines"), F.count(REASON).alias("n_rejected"))
    return Scan(typed(taken.where(F.col(REASON).isNull()), raw, keep), headers, rejected(cut, lines, keep))


def file_period(year: str = "YYYY", month: str = "MM") -> Column:
    """Period 'yyyy-MM-01' from the template values of a file."""
    return F.concat_ws("-", F.col(year), F.col(month), F.lit("01"))
