"""Names, urls and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Families that share a plot template.
FAMILY_MERGES = {
    "IAUA": "IAU", "IAUAN": "IAU", "IAUC": "IAU", "IAUCN": "IAU", "IAUTN": "IAU", "IAUZ": "IAU",
    "AUIRFS": "AUIRF", "AUIRFP": "AUIRF", "AUIRFZ": "AUIRF", "AUIRLU": "AUIRL", "BSC": "BSC-BSZ", "BSZ": "BSC-BSZ",
}
# Words that all have to be in a maker's name (any of the alternatives), and where its data sheets are.
MAKER_URLS = (
    ((("st", "micro"),), "https://www.st.com/resource/en/datasheet/{lower}.pdf"),
    ((("onsemi",), ("on semiconductor",)), "https://www.onsemi.com/download/data-sheet/pdf/{lower}-d.pdf"),
    ((("microchip",),), "https://ww1.microchip.com/downloads/aemDocuments/documents/SCBU/ProductDocuments/DataSheets/{upper}.pdf"),
    ((("nexperia",),), "https://assets.nexperia.com/documents/data-sheet/{upper}.pdf"),
    ((("diodes",),), "https://www.diodes.com/assets/Datasheets/{upper}.pdf"),
)


def model_name(c: Column) -> Column:
    """A part number without the packaging suffix."""
    return F.regexp_replace(F.trim(c), r"(?i)-(TRDKR|DKR|ND)$", "")


def file_name(c: Column) -> Column:
    """A name safe for a path: slashes, brackets and blanks to single underscores, none at the ends."""
    s = F.regexp_replace(F.regexp_replace(c, r"[/\\()]", "_"), r"\s+", "_")
    return F.btrim(F.regexp_replace(s, "_+", "_"), F.lit("_"))


def sheet_url(c: Column) -> Column:
    """A listed url: blank and ``-`` are NULL, ``//`` gets a scheme."""
    t = F.trim(c)
    return F.when(~t.isin("", "-"), F.when(F.startswith(t, F.lit("//")), F.concat(F.lit("https:"), t)).otherwise(t))


def maker_url(part: Column, maker: Column, rules=MAKER_URLS) -> Column:
    """The first rule that fits the maker's name gives the address; NULL without part, maker or rule."""
    p, m, out = F.trim(part), F.lower(F.trim(maker)), None
    for ways, template in rules:
        fits = None
        for words in ways:
            own = None
            for w in words:
                own = m.contains(w) if own is None else own & m.contains(w)
            fits = own if fits is None else fits | own
        kind = "lower" if "{lower}" in template else "upper"
        before, after = template.split("{" + kind + "}")
        url = F.concat(F.lit(before), F.lower(p) if kind == "lower" else F.upper(p), F.lit(after))
        out = F.when(fits, url) if out is None else out.when(fits, url)
    return F.when((p != "") & (m != ""), out)


def normalize_url(c: Column) -> Column:
    """A url with its blanks quoted, as a request needs it."""
    return F.regexp_replace(F.trim(c), " ", "%20")


def device(c: Column) -> Column:
    """The part before ``__``, else the name without its last extension."""
    return F.when(c.contains("__"), F.substring_index(c, "__", 1)).otherwise(F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"(?<=.)\.[^.]*$", ""))


def family(c: Column, merges: dict[str, str] = FAMILY_MERGES) -> Column:
    """Leading letters in upper case (the whole name if there are none), folded to the family they belong to."""
    letters = F.coalesce(F.nullif(F.upper(F.regexp_extract(c, "^([A-Za-z]+)", 1)), F.lit("")), c)
    fold = F.create_map(*[F.lit(x) for kv in merges.items() for x in kv]) if merges else None
    return F.coalesce(F.element_at(fold, letters), letters) if merges else letters


def decision_key(dev: Column, curve: Column) -> Column:
    """``device::curve_type``; NULL if either is missing."""
    return F.when((dev != "") & (curve != ""), F.concat_ws("::", dev, curve))


def band_label(c: Column) -> Column:
    """``max``, ``typ`` or ``min`` for a band's label, NULL for any other text; 98 % counts as max, 2 % as min."""
    s = F.regexp_replace(F.regexp_replace(F.lower(c), r"\s+", ""), r"[.:,;-]+$", "")
    return F.when(s.isin("max", "98%"), "max").when(s == "typ", "typ").when(s.isin("min", "2%"), "min")


def microamp_label(c: Column) -> Column:
    """``ID = 250 uA`` in microamperes; the prefix may be missing (A), m or any micro sign."""
    pattern = r"(?i)I_?D\s*=\s*([\d.]+)\s*(u|µ|μ|m)?A\b"
    v = F.nullif(F.regexp_extract(c, pattern, 1), F.lit("")).try_cast("double")
    prefix = F.regexp_extract(c, pattern, 2)
    return v * F.when(prefix == "", 1e6).when(F.lower(prefix) == "m", 1e3).otherwise(1.0)


# Words of a package drawing, and words of a graph, which overrule them.
OUTLINE_WORDS = ("dimensions", "outline", "inches", "package outline", "mechanical", "footprint", "land pattern")
GRAPH_WORDS = ("parameter:", "= f(", "vs.", "typ.", "max.", "vgs", "vds", "rdson", "rds(on)", "id =", "tj", "gate charge", "capacitance", "impedance")


def _any(s: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | s.contains(w)
    return out


def outline_flag(c: Column) -> Column:
    """Text of a package drawing: one of its words, or ``mm`` by itself but not ``[mm]``, and no word of a graph."""
    s = F.lower(F.coalesce(c, F.lit("")))
    return (_any(s, OUTLINE_WORDS) | s.rlike(r"(?<!\[)\bmm\b")) & ~_any(s, GRAPH_WORDS)
