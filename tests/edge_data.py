"""Fourteen hand-made flights that cover the rules for missing and malformed values."""

import csv
import io

from punctuality.schema import FLIGHT_SCHEMA

EDGE_CSV = """\
FL_DATE,OP_UNIQUE_CARRIER,ORIGIN,ORIGIN_CITY_NAME,DEST,DEP_DELAY,ARR_DELAY,CANCELLED,DISTANCE,CARRIER_DELAY,WEATHER_DELAY,NAS_DELAY,SECURITY_DELAY,LATE_AIRCRAFT_DELAY
2019-01-05,AA,MIA,"Miami, FL",JFK,10.0,12.0,0.0,1089.0,,,,,
2019-01-06,AA,MIA,"Miami, FL",JFK,30.0,40.0,0.0,1089.0,15.0,0.0,5.0,0.0,20.0
2019-07-01,DL,FLL,"Fort Lauderdale, FL",ATL,20.0,15.0,0.0,581.0,0.0,15.0,0.0,0.0,0.0
2019-07-02,DL,FLL,"Fort Lauderdale, FL",ATL,21.0,16.0,0.0,581.0,,,16.0,,
2019-07-03,DL,FLL,"Fort Lauderdale, FL",ATL,,,1.0,581.0,,,,,
2019-07-04,DL,FLL,"Fort Lauderdale, FL",ATL,5.0,6.0,,581.0,,,,,
2019-07-05,DL,ATL,"Atlanta, GA",FLL,8.0,,0.0,581.0,,,,,
2019-07-06,DL,ATL,"Atlanta, GA",FLL,,3.0,0.0,581.0,,,,,
2019-10-01,,ATL,"Atlanta, GA",FLL,1.0,1.0,0.0,581.0,,,,,
2019-10-02,UA,DEN,,ORD,-3.0,-8.0,0.0,888.0,,,,,
bad-date,UA,DEN,"Denver, CO",ORD,2.0,4.0,0.0,888.0,,,,,
,UA,DEN,"Denver, CO",ORD,3.0,5.0,0.0,,,,,,
2019-12-24,UA,DEN,"Denver, CO",ORD,NaN,9.0,0.0,888.0,,,,,
2019-12-25,UA,DEN,"Denver, CO",ORD,4.0,18.0,0.0,888.0,NaN,,,,18.0
"""

SCHEMA_NAMES = [field.split()[0] for field in FLIGHT_SCHEMA.split(",")]


def full_width(text: str = EDGE_CSV, names: list[str] = SCHEMA_NAMES) -> str:
    """The same rows with all 49 columns, the others empty."""
    out = io.StringIO()
    writer = csv.DictWriter(out, names, restval="", lineterminator="\n")
    writer.writeheader()
    writer.writerows(csv.DictReader(io.StringIO(text)))
    return out.getvalue()
