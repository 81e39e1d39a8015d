"""Sources and sinks of transcripts: labelled text files, PDF page lines, and tables of results."""

from __future__ import annotations

import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stenoloom.operators.order import running_total
from stenoloom.operators.turns import TEXT_LABEL


def read_text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file_idx, file_name, page_idx, line_no, line) of every transcript_NNN.txt of a folder."""
    files = spark.read.option("pathGlobFilter", "transcript_*.txt").text(folder, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"(transcript_\d+)\.txt$", 1).alias("file_name"), "value")
    lines = files.select("file_name", F.regexp_extract("file_name", r"(\d+)$", 1).cast("int").alias("file_idx"), F.posexplode(F.split("value", "\r?\n")).alias("i", "line"))
    return lines.select("file_idx", "file_name", F.lit(1).alias("page_idx"), (F.col("i") + 1).alias("line_no"), "line")


def text_turns(lines: DataFrame, label: str = TEXT_LABEL, keep_empty: bool = True) -> DataFrame:
    """(file_idx, turn_idx, raw_name, body) of labelled text; with ``keep_empty`` two versions of a
    file stay one to one, otherwise turns without a body are left out."""
    rows = lines.withColumn("is_label", F.trim("line").rlike(label))
    rows = running_total(rows, "file_idx", "page_idx", "line_no", F.col("is_label"), "turn_idx").where("turn_idx > 0")
    said = F.when(~F.col("is_label") & (F.trim("line") != ""), F.struct("page_idx", "line_no", F.trim("line").alias("line")))
    out = rows.groupBy("file_idx", "turn_idx").agg(
        F.max(F.when(F.col("is_label"), F.trim(F.regexp_extract(F.trim("line"), label, 1)))).alias("raw_name"),
        F.array_join(F.transform(F.sort_array(F.collect_list(said)), lambda x: x["line"]), " ").alias("body"))
    return out if keep_empty else out.where("body <> ''")


def read_pdf_lines(spark: SparkSession, folder: str) -> DataFrame:
    """(file_idx, page_idx, line_no, line, fonts) of transcript_NNN.pdf, the cover page left out;
    needs the PDF library ``fitz`` on the workers and says so where it is missing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "transcript_*.pdf").load(folder).select("path", "content")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import fitz
        except ImportError as e:
            raise ImportError("reading PDF needs the library fitz (PyMuPDF) on every worker") from e
        for frame in frames:
            for path, content in zip(frame.path, frame.content):
                found = re.search(r"transcript_(\d+)\.pdf$", path)
                rows = []
                with fitz.open(stream=content, filetype="pdf") as doc:
                    for page in range(1, doc.page_count):
                        spans = (s for b in doc[page].get_text("rawdict")["blocks"] if b["type"] == 0 for x in b["lines"] for s in x["spans"])
                        fonts = sorted({f"{s['font']} ({round(s['size'])}pt)" for s in spans}) if page <= 3 else []
                        text = doc[page].get_text("text").splitlines()
                        rows += [(int(found[1]), page, k, x, fonts) for k, x in enumerate(text, 1)]
                yield pd.DataFrame(rows, columns=["file_idx", "page_idx", "line_no", "line", "fonts"])

    return files.mapInPandas(read, "file_idx int, page_idx int, line_no int, line string, fonts array<string>")


def turn_text(turn_rows: DataFrame, name: str = "raw_name", skip_empty: bool = True) -> DataFrame:
    """(file_idx, turn_idx, value): each turn as label line, body and blank line."""
    rows = turn_rows.where("body <> ''") if skip_empty else turn_rows
    return rows.select("file_idx", "turn_idx", F.concat(F.col(name), F.lit(":\n"), F.col("body"), F.lit("\n")).alias("value"))


def write_turns(turn_rows: DataFrame, folder: str, name: str = "raw_name", skip_empty: bool = True) -> None:
    """Write the turns as text, one folder file_idx=N for each file with its turns in order."""
    rows = turn_text(turn_rows, name, skip_empty).repartitionByRange("file_idx", "turn_idx").sortWithinPartitions("file_idx", "turn_idx")
    rows.select("file_idx", "value").write.mode("overwrite").partitionBy("file_idx").text(folder)


def write_mapping(ids: DataFrame, folder: str) -> None:
    """Name and id by tab, in order of (id, name)."""
    ids.select("name", "spk_id").orderBy("spk_id", "name").write.mode("overwrite").csv(folder, sep="\t")


def write_workbook(path: str, sheets: dict[str, DataFrame], most_rows: int = 1_000_000) -> None:
    """A workbook with one sheet per table, in plain Office Open XML.

    A sheet of this format holds about a million rows; larger tables belong into Parquet and are
    refused here rather than cut.
    """
    def cell(v) -> str:
        if v is None:
            return "<c/>"
        if isinstance(v, (int, float)) and not isinstance(v, bool):
            return f"<c><v>{v}</v></c>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>'

    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        kinds, names, rels = [], [], []
        for k, (name, df) in enumerate(sheets.items(), 1):
            rows = df.take(most_rows + 1)
            if len(rows) > most_rows:
                raise ValueError(f"{name} has more rows than a sheet holds; write it as Parquet")
            body = "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in [tuple(df.columns), *map(tuple, rows)])
            z.writestr(f"xl/worksheets/sheet{k}.xml", f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{body}</sheetData></worksheet>')
            kinds.append(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>')
            names.append(f'<sheet name="{escape(name[:31])}" sheetId="{k}" r:id="r{k}"/>')
            rels.append(f'<Relationship Id="r{k}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{k}.xml"/>')
        z.writestr("[Content_Types].xml", '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + "".join(kinds) + "</Types>")
        z.writestr("_rels/.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>{"".join(names)}</sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(rels)}</Relationships>')


def summary_text(tables: dict[str, DataFrame], fonts: DataFrame | None = None, most_fonts: int = 20) -> str:
    """The summary mode as text: totals, noise by kind, and the first fonts in order of name.

    ``tables`` are those of ``jobs.summary``; the table per file stays a table, as it has no bound.
    """
    total = tables["overview"].first()
    out = ["OVERVIEW", *(f"{name:<14}{'' if total[name] is None else total[name]}" for name in tables["overview"].columns), f"{'raw speakers':<14}{tables['raw_speakers'].first()[0]}", "", "NOISE LINES"]
    kinds = {r["kind"]: r["n"] for r in tables["noise_totals"].collect()}
    out += [f"{kind:<14}{kinds[kind]}" for kind in sorted(kinds)] + [f"{'total':<14}{sum(kinds.values())}"]
    if fonts is not None:
        names = fonts.select(F.explode("fonts").alias("font")).distinct()
        n = names.count()
        out += ["", "FONTS", *(r["font"] for r in names.orderBy("font").limit(most_fonts).collect())]
        if n > most_fonts:
            out.append(f"... and {n - most_fonts} more")
    return "\n".join(out) + "\n"
