"""Names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def basename(path: Column | str) -> Column:
    """Last segment of a path or URI; NULL where there is none (a bare host has no name)."""
    trimmed = F.rtrim(_col(path), F.lit("/"))
    name = F.substring_index(trimmed, "/", -1)
    return F.when((name != "") & ~trimmed.rlike(r"^[A-Za-z][^/:]*:(//[^/]*)?$"), name)


def require(value: Column, message: str) -> Column:
    """``value``, failing the job with ``message`` where it is NULL."""
    return F.coalesce(value, F.raise_error(F.lit(message)).cast("string"))


def suffix(path: Column | str) -> Column:
    """Extension with its dot, case kept, '' where there is none; leading dots belong to the name."""
    return F.regexp_extract(basename(path), r"^\.*[^.].*(\.[^.]*)$", 1)


def extension(path: Column | str) -> Column:
    return F.lower(suffix(path))


_STEM = r"^(\.*[^.].*?)(\.[^.]*)?$"


def stem(path: Column | str) -> Column:
    """File name without its extension."""
    return F.regexp_extract(basename(path), _STEM, 1)


def dataset_name(path: Column | str) -> Column:
    """File name up to its first dot."""
    return F.substring_index(basename(path), ".", 1)


def tile_id(dataset: Column | str, col: Column | str, row: Column | str) -> Column:
    return F.format_string("%s_x%d_y%d", _col(dataset), _col(col), _col(row))


def tile_path(tile: Column | str) -> Column:
    return F.concat(_col(tile), F.lit(".tif"))


def patch_id(tile: Column | str, row: Column | str, col: Column | str) -> Column:
    return F.format_string("%s_r%d_c%d", _col(tile), _col(row), _col(col))


def join_uri(base: Column | str, *parts: Column) -> Column:
    """Join with single slashes; NULL and empty parts are left out."""
    trimmed = [F.nullif(F.trim(p, F.lit("/")), F.lit("")) for p in parts]
    return F.concat_ws("/", F.rtrim(_col(base), F.lit("/")), *trimmed)


def _replace_first(text: Column, old: str, new: str) -> Column:
    at = F.instr(text, old)
    return F.concat(
        F.substring(text, F.lit(1), at - 1), F.lit(new), F.substring(text, at + len(old), F.length(text))
    )


def processed_path(path: Column | str, file_id: Column | None = None) -> Column:
    """Where the band index of a raw raster goes."""
    p = _col(path)
    moved = (
        F.when(F.instr(p, "/raw/") > 0, _replace_first(p, "/raw/", "/processed/"))
        .when(F.instr(p, "raw") > 0, _replace_first(p, "raw", "processed"))
        .otherwise(p)
    )
    plain = F.concat(moved, F.lit("_ndvi"))
    if file_id is not None:
        given = F.nullif(file_id, F.lit(""))
        plain = F.coalesce(F.concat(F.lit("processed/"), given, F.lit("/ndvi.tif")), plain)
    return F.when(
        moved.endswith(".tif"), F.concat(F.substring(moved, F.lit(1), F.length(moved) - 4), F.lit("_ndvi.tif"))
    ).otherwise(plain)


def results_path(output: Column | str, embeddings_dir: Column | str) -> Column:
    """Result table path; folders and extension-less outputs get the default file name."""
    out = F.coalesce(_col(output), F.lit(""))
    name = F.lit("similarity_results.parquet")
    return (
        F.when(out == "", join_uri(embeddings_dir, name))
        .when(out.endswith("/") | (F.coalesce(suffix(out), F.lit("")) == ""), join_uri(out, name))
        .otherwise(out)
    )


def csv_twin(path: Column | str) -> Column:
    """CSV path written beside a result table."""
    p = _col(path)
    return F.when(F.coalesce(suffix(p), F.lit("")) == "", join_uri(p, F.lit("similarity_results.csv"))).otherwise(
        F.regexp_replace(p, r"\.[^.]*$", ".csv")
    )


STAMP = "yyyyMMdd_HHmmss"


def landed_path(dest: Column, ts: Column, file_id: Column, filename: Column) -> Column:
    """``{dest}/{stamp}_{id}/{filename}``."""
    return F.concat(dest, F.lit("/"), F.date_format(ts, STAMP), F.lit("_"), file_id, F.lit("/"), filename)


def _landed_folder(path: Column | str) -> Column:
    """The ``{stamp}_{id}`` folder a landed file lies in; NULL for other paths."""
    folder = F.substring_index(F.substring_index(_col(path), "/", -2), "/", 1)
    return F.when(folder.rlike(r"^\d{8}_\d{6}_."), folder)


def landed_id(path: Column | str) -> Column:
    """File id inside a landed path; NULL for other paths."""
    return F.substring(_landed_folder(path), 17, 2**31 - 1)


def landed_at(path: Column | str) -> Column:
    """Landing time inside a landed path."""
    return F.try_to_timestamp(F.substring(_landed_folder(path), 1, 15), F.lit(STAMP))


def enriched_name(path: Column | str) -> Column:
    return F.regexp_replace(basename(path), _STEM, "$1_enriched$2")


def glob_regex(glob: str, cross_slash: bool = True) -> str:
    """Java regex for a file glob; ``*`` crosses ``/`` for object-store keys only."""
    star, one = (".*", ".") if cross_slash else ("[^/]*", "[^/]")
    out, i = "", 0
    while i < len(glob):
        ch = glob[i]
        close = glob.find("]", i + 2)
        if ch == "[" and close > 0:
            body = glob[i + 1 : close].replace("\\", "\\\\")
            out += "[" + ("^" + body[1:] if body[0] == "!" else body) + "]"
            i = close
        else:
            out += star if ch == "*" else one if ch == "?" else "\\Q" + ch + "\\E"
        i += 1
    return "^" + out + "$"
