"""Tables from files of unknown dialect, and files that other programs read: CSV with a byte-order mark, JSON, Markdown,
workbooks. Large results are written by Spark; the sinks here are for reports of a bounded size and say so."""

from __future__ import annotations

import csv
import io
import json
import os
import uuid
import zipfile
from pathlib import Path
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitesieve.operators import relational as R


def dialect(head: bytes) -> tuple[str, str]:
    """Encoding and separator of a CSV file, from its first bytes: UTF-8, else cp1251; the commonest of , ; and tab in the
    first line."""
    try:
        text, encoding = head.decode("utf-8-sig"), "UTF-8"
    except UnicodeDecodeError as e:
        cut_off = e.start >= len(head) - 3
        text, encoding = (head[: e.start].decode("utf-8-sig"), "UTF-8") if cut_off else (head.decode("cp1251", "replace"), "windows-1251")
    line = text.splitlines()[0] if text else ""
    return encoding, max(",;\t", key=lambda c: (line.count(c), -",;\t".index(c)))


def read_csv(spark: SparkSession, path: str, probe: int = 4096) -> DataFrame:
    """A CSV file or folder of files of one dialect, every cell a string, empty where there is none. The head of the first
    file is probed through Spark's own reader, so that any file system serves."""
    files = spark.read.format("binaryFile").load(path)
    first = files.select(F.min("path")).first()[0]
    head = spark.read.format("binaryFile").load(first).select(F.substring("content", 1, probe)).first()[0]
    encoding, sep = dialect(bytes(head))
    df = spark.read.csv(path, header=True, sep=sep, multiLine=True, escape='"') if encoding == "UTF-8" else _decoded_csv(files, bytes(head).decode("cp1251"), sep)
    df = df.toDF(*[c.lstrip("﻿").strip() for c in df.columns])
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def _decoded_csv(files: DataFrame, head: str, sep: str) -> DataFrame:
    """cp1251 files, which Spark's reader does not take: each is a row of bytes, decoded and read in its task."""
    names = next(csv.reader(io.StringIO(head), delimiter=sep))

    def run(batches):
        for batch in batches:
            for content in batch.column("content"):
                rows = list(csv.reader(io.StringIO(content.as_py().decode("cp1251", "replace"), newline=""), delimiter=sep))[1:]
                cells = [[r[i] if i < len(r) else None for r in rows if r] for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in cells], names=[f"c{i}" for i in range(len(names))])

    return files.select("content").mapInArrow(run, ", ".join(f"c{i} string" for i in range(len(names)))).toDF(*names)


def read_list(spark: SparkSession, path: str, column: str = "site") -> DataFrame:
    """place, column: the lines of a list without a header."""
    lines = spark.read.text(path).withColumn("place", F.monotonically_increasing_id())
    return lines.filter(F.trim("value") != "").select("place", F.trim(F.regexp_replace("value", "^﻿", "")).alias(column))


def by_file(spark: SparkSession, glob: str, name: str = "batch") -> DataFrame:
    """CSV files of one shape with a column of their names, without folder and endings."""
    df = spark.read.csv(glob, header=True, escape='"', multiLine=True)
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_name"), r"^([^.]+)", 1))


def parts(spark: SparkSession, glob: str, key: str) -> DataFrame:
    """Part files of one table; a key in two rows is an error."""
    df = by_file(spark, glob, "part")
    twice = df.groupBy(key).count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"{key} is repeated: {[r[0] for r in twice]}")
    return df


def renamed(df: DataFrame, aliases: dict[str, tuple[str, ...]], required: tuple[str, ...] = ()) -> DataFrame:
    """Columns under their logical names, whichever alias the file uses; a required one that is missing is an error."""
    found = {k: next((c for c in df.columns if c.strip().lower() in names), None) for k, names in aliases.items()}
    missing = [k for k in required if found[k] is None]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.withColumnsRenamed({c: k for k, c in found.items() if c})


def with_appended(df: DataFrame, columns: dict) -> DataFrame:
    """All columns as they are, and the new ones after them (a known name keeps its place)."""
    return df.withColumns(columns)


def placed_after(columns: list[str], anchor: str, moved: list[str]) -> list[str]:
    """The columns with `moved` right after the anchor."""
    rest = [c for c in columns if c not in moved]
    at = rest.index(anchor) + 1
    return rest[:at] + moved + rest[at:]


def without_empty(df: DataFrame) -> DataFrame:
    """df without the columns that are empty in every row: one pass over it."""
    cells = {c: F.coalesce(F.max(F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) != ""), F.lit(False)) for c in df.columns}
    some = df.agg(*[x.alias(f"c{i}") for i, x in enumerate(cells.values())]).first()
    return df.select([F.col(f"`{c}`") for i, c in enumerate(df.columns) if some[i]])


def split_by_reason(df: DataFrame, reason) -> tuple[DataFrame, DataFrame]:
    """The rows without a reason, and those with one, the side output."""
    x = df.withColumn("reason", reason)
    return x.filter("reason is null").drop("reason"), x.filter("reason is not null")


def routed(base: DataFrame, other: DataFrame, on: list[str], wanted: str, status: str = "status") -> dict[str, DataFrame]:
    """LEFT JOIN on a composite key, and the rows by what the other side says: matched, unmatched, refused."""
    x = base.join(other.select(*on, status), on, "left")
    return {"matched": x.filter(F.col(status) == wanted), "unmatched": x.filter(F.col(status).isNull()), "refused": x.filter(F.col(status).isNotNull() & (F.col(status) != wanted))}


def looked_up(df: DataFrame, dictionary: DataFrame, key: str, value: str, most: int = 100_000) -> DataFrame:
    """Dictionary join in which a miss is fatal. The dictionary is broadcast if it has at most `most` rows."""
    small = dictionary.limit(most + 1).count() <= most
    x = df.join(F.broadcast(dictionary) if small else dictionary, key, "left")
    misses = x.filter(F.col(value).isNull()).select(key).distinct().limit(5).collect()
    if misses:
        raise ValueError(f"no {value} for {[r[0] for r in misses]}")
    return x


def two_verdicts(df: DataFrame, first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """df with the verdicts of two tables, first_verdict and second_verdict; empty where one has none."""
    side = lambda t, n: t.select(key, F.col("verdict").alias(n))
    return df.join(side(first, "first_verdict"), key, "left").join(side(second, "second_verdict"), key, "left").na.fill("", ["first_verdict", "second_verdict"])


def unknown_keys(df: DataFrame, key: str, known: DataFrame) -> DataFrame:
    return df.select(key).distinct().join(known.select(key).distinct(), key, "left_anti")


def limited_unless_explicit(df: DataFrame, order: list[str], explicit: str, n: int) -> DataFrame:
    """Rows with `place`: kept, or over limit for those past the n-th that no explicit list holds."""
    within = df.filter(~F.col(explicit)).orderBy(*order).limit(n).select(*order).withColumn("_in", F.lit(True))  # n rows
    x = df.join(F.broadcast(within), order, "left")
    return x.withColumn("place", F.when(F.col(explicit) | F.col("_in"), "kept").otherwise("over limit")).drop("_in")


def furthest(df: DataFrame, group: str, key: str, by: list) -> DataFrame:
    """Argmax at two levels: the best row of each key, then the best key of each group."""
    best = R.argmax(df.select(group, key, F.struct(*by).alias("by"), F.struct(*by, F.col(key)).alias("all")), [group, key], "all", [F.col("by")])
    return best.groupBy(group).agg(F.max_by(key, "all").alias(key))


def picked_by_key(df: DataFrame, key, share: float, seed: str) -> DataFrame:
    """A sample that a key's hash decides: the same rows in every run, and of any larger table."""
    u = F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(seed), key), 256), 1, 8), 16, 10).cast("double") / 2.0**32
    return df.filter(u < share)


def _replace(path: str, data: bytes) -> None:
    temporary = f"{path}.{uuid.uuid4().hex}"
    Path(temporary).write_bytes(data)
    os.replace(temporary, path)


def _rows(df: DataFrame, most: int) -> list:
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"a report of more than {most} rows: write it with Spark")
    return rows


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, most: int = 100_000) -> None:
    """One CSV file for other programs: byte-order mark, CRLF, quotes where needed, put in place at once."""
    columns = columns or df.columns
    cell = lambda v: "" if v is None else f'"{str(v).replace(chr(34), chr(34) * 2)}"' if any(c in str(v) for c in ',"\r\n') else str(v)
    lines = [",".join(map(cell, columns)), *(",".join(map(cell, r)) for r in _rows(df.select(*columns), most))]
    _replace(path, ("﻿" + "\r\n".join(lines) + "\r\n").encode())


def write_json(df: DataFrame, path: str, most: int = 100_000) -> None:
    _replace(path, json.dumps([r.asDict(True) for r in _rows(df, most)], ensure_ascii=False, indent=1, default=str).encode())


def write_markdown(df: DataFrame, path: str, title: str, most: int = 10_000) -> None:
    bar = lambda cells: "| " + " | ".join(str("" if c is None else c).replace("|", "\\|").replace("\n", " ") for c in cells) + " |"
    lines = [f"# {title}", "", bar(df.columns), bar(["---"] * len(df.columns)), *(bar(r) for r in _rows(df, most))]
    _replace(path, ("\n".join(lines) + "\n").encode())


_SHEET = '<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{}</sheetData></worksheet>'


def write_workbook(sheets: dict[str, DataFrame], path: str, most: int = 100_000) -> None:
    """An .xlsx workbook, a sheet a table, cells as text or numbers."""
    letters = lambda n: (letters(n // 26 - 1) if n >= 26 else "") + chr(65 + n % 26)

    def cell(r: int, c: int, v) -> str:
        at = f"{letters(c)}{r}"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f'<c r="{at}"><v>{v}</v></c>'
        return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape("" if v is None else str(v))}</t></is></c>'

    book, relations, types = [], [], []
    temporary = f"{path}.{uuid.uuid4().hex}"
    with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as z:
        for i, (name, df) in enumerate(sheets.items(), 1):
            rows = [df.columns, *map(tuple, _rows(df, most))]
            z.writestr(f"xl/worksheets/sheet{i}.xml", _SHEET.format("".join(f'<row r="{r}">{"".join(cell(r, c, v) for c, v in enumerate(row))}</row>' for r, row in enumerate(rows, 1))))
            book.append(f'<sheet name="{escape(name[:31])}" sheetId="{i}" r:id="rId{i}"/>')
            relations.append(f'<Relationship Id="rId{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>')
            types.append(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
        z.writestr("xl/workbook.xml", f'<?xml version="1.0" encoding="UTF-8"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{"".join(book)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(relations)}</Relationships>')
        z.writestr("_rels/.rels", '<?xml version="1.0" encoding="UTF-8"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("[Content_Types].xml", f'<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{"".join(types)}</Types>')
    os.replace(temporary, path)


def markdown_tables(lines: DataFrame) -> DataFrame:
    """doc, section, table, row, cells of Markdown lines (doc, place, line): runs of lines that begin with a bar; the rule
    under a header is no row."""
    w = Window.partitionBy("doc").orderBy("place")
    is_row = F.trim("line").startswith("|")
    x = lines.withColumn("heading", F.when(F.col("line").rlike(r"^#+\s"), F.trim(F.regexp_replace("line", r"^#+\s*", ""))))
    x = R.islands(x.withColumn("section", F.last("heading", ignorenulls=True).over(w)), ["doc"], ["place"], is_row).filter(is_row & ~F.col("line").rlike(r"^\s*\|[\s:|-]+\|\s*$"))
    cells = F.transform(F.split(F.regexp_replace(F.trim("line"), r"^\||\|$", ""), r"(?<!\\)\|"), lambda c: F.trim(F.replace(c, F.lit("\\|"), F.lit("|"))))
    return x.select("doc", F.coalesce("section", F.lit("")).alias("section"), F.col("island").cast("bigint").alias("table"), F.row_number().over(Window.partitionBy("doc", "island").orderBy("place")).alias("row"), cells.alias("cells"))
