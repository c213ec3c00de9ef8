"""Vendors' part lists (CSV) as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names, parsing

# Device type -> field -> headers that may name it, in order of preference.
_SILICON = {
    "ModelName": ["Mfr Part #", "Part Number", "Manufacturer Part Number", "Mfr Part Number"], "manufacturer": ["Mfr", "Manufacturer", "Manufacture"],
    "Vdss": ["Drain to Source Voltage (Vdss)", "Voltage - Drain to Source", "Drain Source Voltage", "Vdss"],
    "Id": ["Current - Continuous Drain (Id) @ 25°C", "Drain Current", "Continuous Drain Current", "Id"], "Id_pulse": ["Current - Pulsed Drain (Idm)", "Pulsed Drain Current"],
    "Rdson": ["Rds On (Max) @ Id, Vgs", "Rds(on)", "RDS(ON)", "Drain-Source On Resistance", "Drain Source On Resistance"],
    "Vgs_th": ["Vgs(th) (Max) @ Id", "Gate Threshold Voltage", "Vgs_th"], "Qg": ["Gate Charge (Qg) (Max) @ Vgs", "Total Gate Charge", "Charge - Gate (Qg)", "Qg"],
    "Qgs": ["Gate Charge (Qgs)", "Gate-Source Charge", "Charge - Gate to Source"], "Qgd": ["Gate Charge (Qgd)", "Gate-Drain Charge", "Charge - Gate to Drain"],
    "Ciss": ["Input Capacitance (Ciss) (Max) @ Vds", "Input Capacitance", "Capacitance @ Vds - Ciss"], "Coss": ["Output Capacitance (Coss)", "Output Capacitance", "Capacitance @ Vds - Coss"],
    "Crss": ["Reverse Transfer Capacitance (Crss)", "Reverse Transfer Capacitance"], "Qrr": ["Reverse Recovery Charge (Qrr)", "Reverse Recovery Charge"],
    "Pd": ["Power Dissipation (Max)", "Power Dissipation", "Power - Max"], "R_theta_JC": ["Thermal Resistance Junction-Case", "Rth(j-c)", "Rthjc"], "R_theta_JA": ["Thermal Resistance Junction-Ambient"],
    "Tjmax": ["Operating Temperature", "Operating Temperature - Junction"], "package": ["Package / Case", "Package/Case", "Package"], "mounting": ["Mounting Type", "Mounting"],
    "channel_polarity": ["FET Type", "Channel Polarity"], "product_status": ["Product Status", "Part Status", "Status"], "technology": ["Technology"], "Cost": ["Price", "Unit Price", "Unit Price (USD)"],
    "pdf_url": ["Datasheet", "Datasheet Link", "Datasheet URL"], "Vf": ["Diode Forward Voltage", "Body Diode Forward Voltage"], "td_on": ["Turn-On Delay Time"], "td_off": ["Turn-Off Delay Time"],
    "tr": ["Rise Time"], "tf": ["Fall Time"], "trr": ["Reverse Recovery Time"], "Is": ["Diode Continuous Forward Current", "Current - Diode (Continuous)"],
    "Vgs_max": ["Vgs (Max)", "Gate-Source Voltage (Max)", "Drive Voltage (Max)"], "supplier_part_number": ["Digi-Key Part #", "Supplier Part Number", "DigiKey Part Number"],
    "description": ["Description", "Detailed Description"], "stock_available": ["Stock", "Quantity Available", "Digi-Key Stock"],
}
_IGBT = {
    "ModelName": ["Mfr Part #", "Part Number", "Manufacturer Part Number"], "manufacturer": ["Mfr", "Manufacturer", "Manufacture"],
    "Vdss": ["Vces", "VCES", "Collector-Emitter Breakdown Voltage", "Voltage - Collector Emitter Breakdown"], "Id": ["Ic", "IC", "Collector Current", "Collector Current - Continuous", "Current - Collector (Ic)"],
    "Vce_sat": ["Vce(sat)", "VCE(sat)", "Collector-Emitter Saturation Voltage"], "Vgs_th": ["Vge(th)", "VGE(th)", "Gate Threshold Voltage"], "Qg": ["Qg", "QG", "Total Gate Charge", "Charge - Gate"],
    "Ciss": ["Ciss", "CISS", "Input Capacitance"], "R_theta_JC": ["Rth(j-c)", "Rthjc", "Thermal Resistance Junction-Case"], "eon_ref": ["Eon", "EON", "Turn-On Energy"], "eoff_ref": ["Eoff", "EOFF", "Turn-Off Energy"],
    "Tjmax": ["Tj(max)", "TJ(max)", "Operating Temperature - Junction", "Operating Temperature"], "package": ["Package", "Package / Case", "Case"], "mounting": ["Mounting", "Mounting Type"],
    "Cost": ["Unit Price", "Price", "Unit Price (USD)"], "product_status": ["Product Status", "Status", "Part Status"], "pdf_url": ["Datasheet", "Datasheet Link"], "stock_available": ["Stock", "Quantity Available", "Digi-Key Stock"],
}
_GAN = {
    "ModelName": ["Mfr Part #", "Part Number", "Manufacturer Part Number"], "manufacturer": ["Mfr", "Manufacturer", "Manufacture"], "Vdss": ["Vds", "VDS", "Drain-Source Voltage", "Voltage - Drain to Source"],
    "Id": ["Id", "ID", "Drain Current", "Drain Current - Continuous", "Current - Continuous Drain"], "Rdson": ["Rds(on)", "RDS(ON)", "Drain-Source On Resistance", "Rdson", "RDSon"],
    "Vgs_th": ["Vgs(th)", "VGS(th)", "Gate Threshold Voltage"], "Qg": ["Qg", "QG", "Total Gate Charge", "Charge - Gate"], "Ciss": ["Ciss", "CISS", "Input Capacitance"],
    "Crss": ["Crss", "CRSS", "Reverse Transfer Capacitance"], "Coss": ["Coss", "COSS", "Output Capacitance"], "R_theta_JC": ["Rth(j-c)", "Rthjc", "Thermal Resistance", "Thermal Resistance Junction-Case"],
    "Qrr": ["Qrr", "QRR", "Reverse Recovery Charge"], "Tjmax": ["Tj(max)", "TJ(max)", "Operating Temperature", "Operating Temperature - Junction"], "package": ["Package", "Package / Case", "Case"],
    "mounting": ["Mounting", "Mounting Type"], "Cost": ["Unit Price", "Price", "Unit Price (USD)"], "product_status": ["Product Status", "Status", "Part Status"], "pdf_url": ["Datasheet", "Datasheet Link"],
    "stock_available": ["Stock", "Quantity Available", "Digi-Key Stock"],
}
DEVICE_TYPES = {"Si-MOSFET": _SILICON, "SiC-MOSFET": _SILICON, "GaN-HEMT": _GAN, "IGBT": _IGBT}


def find_column(headers: list[str], field: str, device_type: str) -> str | None:
    """The header of a field: aliases in order, case and outer blanks aside; a field without aliases goes by its name."""
    by = {}
    for h in headers:
        by.setdefault(h.strip().lower(), h)
    return next((by[a.lower()] for a in DEVICE_TYPES[device_type].get(field, [field]) if a.lower() in by), None)


def map_columns(headers: list[str], device_type: str) -> dict[str, str]:
    """Field -> header for all fields of the type that the list has."""
    return {f: h for f in DEVICE_TYPES[device_type] if (h := find_column(headers, f, device_type)) is not None}


def parse_rows(raw: DataFrame, device_type: str) -> DataFrame:
    """All-string rows to typed ones: one narrow projection, unread headers never leave the scan.

    A row without a part number keeps only a ``skip_reason``; a cell that can't be read is NULL and the row stays. A list
    without a part-number column is an error.
    """
    fields = map_columns(raw.columns, device_type)
    if "ModelName" not in fields:
        raise ValueError(f"no part-number column for {device_type} among {raw.columns}")
    cells = {f: F.col(f"`{h}`").cast("string") for f, h in fields.items()}
    part = parsing.clean_string(cells["ModelName"])
    out = [names.model_name(part).alias("ModelName"), F.when(part.isNotNull(), F.trim(cells["ModelName"])).alias("_raw_part_number")]
    for f, c in cells.items():
        if f == "Tjmax":
            both = parsing.temperature_range(c)
            out += [both["low"].alias("Tjmin"), both["high"].alias("Tjmax")]
        elif f != "ModelName":
            out.append((parsing.PARSERS[f](c) if f in parsing.PARSERS else parsing.clean_string(c)).alias(f))
    keep = [c for c in raw.columns if c == "_row"]
    return raw.select(*keep, *out, F.when(part.isNull(), "missing ModelName").alias("skip_reason"))


def read_csv(spark: SparkSession, path: str, device_type: str, limit: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Kept rows and skipped rows (with their reason) of a CSV part list; ``limit`` counts kept rows, in file order.

    A header that occurs twice is read at its first place (Spark numbers the columns, so it is no longer by chance).
    """
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding="UTF-8", inferSchema=False)
    clean = [c.lstrip("﻿") for c in raw.columns]
    first: dict[str, str] = {}
    for c in clean:
        base = c.rstrip("0123456789") if c not in first and c.rstrip("0123456789") in first else c
        first.setdefault(base, c)
    raw = raw.toDF(*clean)
    rows = parse_rows(raw.withColumn("_row", F.monotonically_increasing_id()), device_type)
    kept = rows.where("skip_reason IS NULL").drop("skip_reason")
    if limit is not None:
        kept = kept.orderBy("_row").limit(limit)
    return kept.drop("_row"), rows.where("skip_reason IS NOT NULL").select("_row", "skip_reason")
