"""Decoding of message and name fields as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File kinds by the first pattern that a name matches; the order counts.
FILE_PATTERNS = [
    (r"(?i)\.\d{2}o$", "rinex2"),
    (r"sonardyne", "sonardyne"),
    (r"(?i)^(?=.*novatel)(?!.*pin).*$", "novatelpin"),
    (r"novatel", "novatel"),
    (r"kin", "kin"),
    (r"NOV000", "novatel000"),
    (r"NOV770", "novatel770"),
    (r"DFOP00.raw", "dfop00"),
    (r"lever_arms", "leverarm"),
    (r"master", "master"),
    (r"\.pin$", "qcpin"),
    (r"CTD", "ctd"),
    (r"svpavg", "seabird"),
    (r"\.res$", "kinresiduals"),
    (r"bcoffload", "bcoffload"),
    (r"seabird", "seabird"),
]

# Survey types and their aliases; what fits none is "other".
SURVEY_TYPES = [
    (r"^(circle|circledrive|circle drive)$", "circle"),
    (r"^(fixed point|fixedpoint)$", "fixed_point"),
    (r"^mixed$", "mixed"),
    (r"^center$", "center"),
    (r"^garpos$", "garpos"),
    (r"^(movearound|move around)$", "movearound"),
]

# Numbers of the satellite systems.
GPS, GLONASS = 0, 1
SYSTEMS = (0, 1, 2, 3, 5, 6, 7)

ARCHIVE_ROOT = "archive"


def file_kind(name: Column) -> Column:
    """The kind of a file by its name; null if no pattern fits."""
    out = F.lit(None).cast("string")
    for pattern, kind in reversed(FILE_PATTERNS):
        out = F.when(name.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def classify_file(path: Column, length: Column) -> Column:
    """As file_kind, of a path's last part; empty files and names that begin with ._ have none."""
    name = F.regexp_extract(path, r"[^/]*$", 0)
    return F.when((length > 0) & ~name.startswith("._"), file_kind(name))


def survey_type(text: Column) -> Column:
    low = F.lower(text)
    out = F.lit("other")
    for pattern, kind in reversed(SURVEY_TYPES):
        out = F.when(low.rlike(pattern), F.lit(kind)).otherwise(out)
    return out


def high_rate(path: Column) -> Column:
    """Whether a file name is not of 1 Hz data."""
    return ~F.lower(path).contains("1hz")


def transponder_code(text: Column) -> Column:
    """The digits of a transponder name, led by M."""
    digits = F.regexp_replace(text, r"\D", "")
    return F.when(digits.rlike(r"^\d"), F.concat(F.lit("M"), digits)).otherwise(digits)


def scalar_of(text: Column) -> Column:
    """A number that may stand in a list of one, [12.5] or 12.5, as double."""
    return F.regexp_extract(text, r"-?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?", 0).try_cast("double")


def tracking_word(word: Column, system_mask: int = 7) -> dict[str, Column]:
    """Fields of a 32-bit tracking status word (long).

    The system is read with 3 bits, since real words set the two bits above; system_mask=31 reads all five.
    """
    bits = lambda shift, mask: F.shiftright(word, shift).bitwiseAND(F.lit(mask).cast("long"))
    return {
        "tracking_state": bits(0, 31),
        "channel": bits(5, 31),
        "phase_lock": bits(10, 7),
        "parity_known": bits(13, 1) == 1,
        "code_lock": bits(14, 1) == 1,
        "system": bits(16, system_mask),
        "signal": bits(21, 31),
        "half_cycle": bits(28, 1) == 1,
        "prn_lock": bits(31, 1) == 1,
    }


def hex_to_long(text: Column) -> Column:
    return F.when(text.rlike(r"^[0-9A-Fa-f]{1,15}$"), F.conv(text, 16, 10).cast("long"))


def campaign_year(name: Column) -> Column:
    """The year of a campaign name YYYY_L_VVVV; null if the name has another form."""
    return F.when(name.rlike(r"^\d{4}_[A-Za-z]_\w{4}$"), F.split_part(name, F.lit("_"), F.lit(1)).cast("int"))


def archive_path(network: Column, station: Column, campaign: Column, last: str = "raw") -> Column:
    return F.concat_ws("/", F.lit(ARCHIVE_ROOT), network, F.split_part(campaign, F.lit("_"), F.lit(1)), station, campaign, F.lit(last))
