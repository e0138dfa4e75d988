"""Hand-made landing files: one record builder, and a folder writer."""

import json
from pathlib import Path

AIRPORTS = [("ATL", "Atlanta", "Atlanta", 33.64, -84.43), ("EWR", "Newark", "Newark", 40.69, -74.17),
            ("LAX", "Los Angeles", "Los Angeles", 33.94, -118.41), ("MIA", "Miami", "Miami", 25.8, -80.29),
            ("SFO", "San Francisco", "San Francisco", 37.62, -122.38)]


def flight(iata="AA1", airline=("American Airlines", "AA", "AAL"), icao="AAL1", codeshared=None, dep="JFK", arr="SFO",
           dep_zone="America/New_York", arr_zone="America/Los_Angeles", dep_sched="2026-09-16T10:00:00",
           dep_act="2026-09-16T10:20:00", arr_sched="2026-09-16T13:00:00", arr_act="2026-09-16T13:05:00",
           status="landed", delays=("5", None), day="2026-09-16"):
    def end(code, zone, sched, act, delay):
        stamp = lambda x: None if x is None else x + "+00:00"
        return {"iata": code, "timezone": zone, "scheduled": stamp(sched), "actual": stamp(act),
                "actual_runway": stamp(act), "estimated": None, "delay": delay}

    name, a_iata, a_icao = airline
    return {"flight_date": day, "flight_status": status, "airline": {"name": name, "iata": a_iata, "icao": a_icao},
            "flight": {"iata": iata, "icao": icao, "codeshared": codeshared}, "aircraft": {"icao24": "A1B2"},
            "departure": end(dep, dep_zone, dep_sched, dep_act, delays[0]),
            "arrival": end(arr, arr_zone, arr_sched, arr_act, delays[1])}


def reading(dt, temp=60.0, wind=8.0, gust=None, main="Clear", description="clear sky", **more):
    return {"name": "Station", "coord": {"lat": 37.6, "lon": -122.4}, "main": {"temp": temp, "feels_like": temp,
            "humidity": 55, "pressure": 1012}, "wind": {"speed": wind, **({} if gust is None else {"gust": gust})},
            "visibility": 10000, "clouds": {"all": 20}, "weather": [{"main": main, "description": description}],
            "dt": dt, **more}


def write(root: Path, key: str, body) -> None:
    path = root / key
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body if isinstance(body, str) else json.dumps(body))


def documents(spark, bodies):
    """(raw_data, source_file) from (key, body) pairs, as the landing reader would give them."""
    rows = [(b if isinstance(b, str) else json.dumps(b), k) for k, b in bodies]
    return spark.createDataFrame(rows, "raw_data STRING, source_file STRING")


def airports(spark):
    return spark.createDataFrame(
        AIRPORTS, "iata_code STRING, airport_name STRING, city STRING, latitude DOUBLE, longitude DOUBLE")
