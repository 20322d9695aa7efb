"""Writes small event CSV files (51 columns) into a landing folder."""

from __future__ import annotations

import gzip
import os

from stormmart.schemas import HEADER_NAMES, SOURCE_NAMES


def _quote(v: str | None) -> str:
    if v is None:
        return ""
    if any(ch in v for ch in ',"\n') or v == "":
        return '"' + v.replace('"', '""') + '"'
    return v


def event_row(i: int, **over) -> dict:
    row = {n: None for n in SOURCE_NAMES}
    # An invented hail report.
    row.update({
        "begin_yearmonth": "200707", "begin_day": str(1 + i % 28), "begin_time": "605",
        "end_yearmonth": "200707", "end_day": str(1 + i % 28), "end_time": "640",
        "episode_id": str(70 + i), "event_id": str(10000 + i), "state": "OKLAHOMA",
        "state_fips": "7", "year": "2007", "month_name": "July", "event_type": "Hail",
        "cz_type": "Z", "cz_fips": "12", "cz_name": "INVENTED", "wfo": "ABC",
        "begin_date_time": "09-JUL-07 06:05:00", "cz_timezone": "MST",
        "end_date_time": "09-JUL-07 06:40:00", "injuries_direct": "2", "injuries_indirect": "1",
        "deaths_direct": "0", "deaths_indirect": "0", "damage_property": f"{i}K",
        "damage_crops": "5K", "source": "Made up", "magnitude": "1.75",
        "begin_lat": "10.5", "begin_lon": "20.25", "end_lat": "10.75", "end_lon": "20.5",
        "data_source": "TST",
    })
    row.update(over)
    return row


def write_csv(path: str, rows: list[dict], header_every: int | None = None,
              gz: bool = True, newline: str = "\n") -> str:
    lines = [",".join(HEADER_NAMES)]
    for j, r in enumerate(rows):
        if header_every and j and j % header_every == 0:
            lines.append(",".join(HEADER_NAMES))
        lines.append(",".join(_quote(r[n]) for n in SOURCE_NAMES))
    data = (newline.join(lines) + newline).encode("utf-8")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    if gz:
        with gzip.open(path, "wb") as fh:
            fh.write(data)
    else:
        with open(path, "wb") as fh:
            fh.write(data)
    return path
