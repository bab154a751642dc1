"""Table schemas and the rules that their rows must meet."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.timeutil import GPS_EPOCH, LEAP_SECONDS


_TYPES = {"double": T.DoubleType, "float": T.FloatType, "long": T.LongType, "int": T.IntegerType, "short": T.ShortType, "byte": T.ByteType, "string": T.StringType, "boolean": T.BooleanType, "timestamp": T.TimestampType}


def _of(text: str) -> T.StructType:
    """A flat schema from "name type" or "name type not null", comma-separated; needs no session."""
    parts = [x.split() for x in text.split(",")]
    return T.StructType([T.StructField(p[0], _TYPES[p[1]](), len(p) == 2) for p in parts])


_ENDS = ", ".join(f"{a}{k} double" for k in (0, 1) for a in ("head", "pitch", "roll", "east", "north", "up"))
_STDS = ", ".join(f"{a}_std{k} double" for k in (0, 1) for a in ("east", "north", "up"))

SCHEMAS: dict[str, T.StructType] = {
    "shot": _of(f"pingTime double not null, transponderID string not null, returnTime double not null, tt double not null, dbv float, xc short, snr double, tat double, {_ENDS}, {_STDS}, isUpdated boolean"),
    "acoustic": _of("time timestamp not null, transponderID string not null, returnTime timestamp, tt double, dbv float, xc short, snr double, tat double"),
    "kin": _of("time timestamp not null, latitude double, longitude double, height double, east double, north double, up double, number_of_satellites short, pdop double, wrms double, east_std double, north_std double, up_std double"),
    "imu": _of("time timestamp not null, azimuth double, pitch double, roll double, latitude double, longitude double, height double, northVelocity double, eastVelocity double, upVelocity double, latitude_std double, longitude_std double, height_std double, northVelocity_std double, eastVelocity_std double, upVelocity_std double, roll_std double, pitch_std double, azimuth_std double"),
    "observation": _of("time long not null, sys short not null, sat short not null, obs int not null, range double, phase double, doppler double, snr float, slip int, flags long, fcn byte"),
    "svp": _of("depth double, speed double"),
    "model_input": _of("SET string, LN string, MT string, TT double, ResiTT double, TakeOff double, gamma double, flag boolean, ST double, RT double, ant_e0 double, ant_n0 double, ant_u0 double, head0 double, pitch0 double, roll0 double, ant_e1 double, ant_n1 double, ant_u1 double, head1 double, pitch1 double, roll1 double"),
    "model_output": _of("MT string, TT double, ST double, RT double, flag boolean, gamma double, ResiTT double, TakeOff double, head1 double, ResiRange double, dV0 double, gradV1e double, gradV1n double, gradV2e double, gradV2n double, dV double, LogResidual double"),
    "asset": _of("id long, type string, network string, station string, campaign string, local_path string, remote_path string, timestamp_created timestamp, is_processed boolean, parent_id long"),
    "merge_job": _of("child_type string, parent_type string, signature string"),
}

_SCALAR = "string"  # one number or a list of one

#: One event of an event log or pin file, as DDL.
EVENT = (
    "struct<event: string, event_id: int, sequence: int, type: string, uid: string,"
    " time: struct<common: double, instrument: double, start_count: int, status: string>,"
    " observations: struct<"
    "AHRS: struct<h: double, p: double, r: double, time: struct<common: double>>,"
    " GNSS: struct<hae: double, latitude: double, longitude: double, sdx: double, sdy: double, sdz: double, q: int, time: struct<common: double>>,"
    " NOV_HEADING: struct<h: double, p: double, gpst: double>,"
    " NOV_INS: struct<h: double, p: double, r: double, latitude: double, longitude: double, hae: double, vx: double, vy: double, vz: double>,"
    " NOV_RANGE: struct<raw: string>>,"
    f" range: struct<cn: string, `range`: double, tat: double, diag: struct<dbv: {_SCALAR}, snr: {_SCALAR}, xc: {_SCALAR}>>>"
)

#: The first instant of GNSS time in Unix seconds.
START = float(GPS_EPOCH - LEAP_SECONDS)


def _within(column: str, low: float | None, high: float | None = None) -> tuple[str, Column]:
    c = F.col(column)
    ok = (c >= F.lit(low)) if high is None else c.between(F.lit(low), F.lit(high))
    return f"{column} out of range", ok | c.isNull()


def _present(column: str) -> tuple[str, Column]:
    return f"{column} missing", F.col(column).isNotNull()


#: Rules by table: a reason and a predicate that a good row meets. All limits are inclusive.
RULES: dict[str, list[tuple[str, Column]]] = {}


def rules(table: str) -> list[tuple[str, Column]]:
    """The rules of a table; made when first asked for, since columns need a session."""
    if not RULES:
        signal = [_within("tt", 0, 600), _within("xc", 0, 100), _within("snr", -100, 100), _within("tat", 0, 10)]
        place = [_within("latitude", -90, 90), _within("longitude", -180, 360)]
        RULES["shot"] = [_present("pingTime"), _present("transponderID"), _present("returnTime"), _present("tt"), *signal, _within("pingTime", START), _within("returnTime", START)]
        RULES["acoustic"] = [_present("time"), _present("transponderID"), *signal]
        RULES["kin"] = [_present("time"), *place, _within("height", -101, 100), *[_within(c, -6378100, 6378100) for c in ("east", "north", "up")], _within("number_of_satellites", 0, 125), _within("pdop", 0, 1000), _within("wrms", 0, 1000)]
        RULES["imu"] = [_present("time"), *place, _within("azimuth", -180, 360), _within("pitch", -90, 90), _within("roll", -180, 180), _within("height", -6378100, 6378100)]
        RULES["svp"] = [_present("depth"), _present("speed"), _within("depth", 0, 10000), _within("speed", 0, 3800)]
    return RULES[table]
