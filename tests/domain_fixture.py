"""Hand-written raw exports with the edge rows of FIXTURES.md section 3.

Written as the delimited files the reader expects, so a test goes through
the same readers as a real run.
"""

from __future__ import annotations

import os

SESSIONS = """Session ID;Observer ID;Actual Observer Name;Submitter ID;Submitted by;Start Date;City;Country;Latitude;Longitude;Elevation
1;101;José  Silva;101;Jose Silva;2022-01-03 21:15:30;Rio , Centro;Brasil;-22.9;-43.2;10
2;102;Anna;103;Björn Ødegaard-Ström;2022-01-04 22:00:00;Oslo;Norway;59.9;10.7;
3;abc;Γιώργος Παπαδόπουλος;;;2022-07-01 03:30:00;123;Greece;37.9;23.7;70
4;104;Mary O'Neil;104;Mary O'Neil;"2000-02-29 05:00:00";;Ireland;;;
5;105;Hans Groß;105;Hans Groß;2022-06-30 06:45:10;München;Deutschland;48.1;11.6;520
6;106;Li Wei;106;Li Wei;;Beijing;China;39.9;116.4;44
7;107;Two Place;107;Two Place;2022-01-05 23:10:00;Lisboa;Portugal;38.7;-9.1;50
8;108;Other Place;108;Other Place;2022-01-05 23:20:00;Lisboa;Portugal;38.7;-9.1;75
9;109;Late Session;109;Late Session;1900-12-31 20:00:00;Far;Away;10.0;10.0;0
"""

RATES = """Rate ID;Obs Session ID;Start Date;End Date;Ra;Decl;Teff;F;Shower;Method;Number
1;1;2022-01-03 21:15:30;2022-01-03 22:16:01;230;49;1.0;1.0;QUA;Visual;30
2;1;2022-01-03 22:15:47;2022-01-03 23:00:00;230;49;0.75;1.1;QUA;Visual;25
3;2;2022-01-04 22:00:00;2022-01-04 23:00:00;100;10;1.0;1.0;SPO;Visual;5
4;3;2022-07-01 03:30:00;2022-07-01 04:30:00;300;-10;1.0;1.0;XYZ;Video;7
5;5;2022-06-30 06:45:10;2022-06-30 07:45:10;200;20;1.0;1.0;PER;;12
6;6;2022-01-06 01:00:00;2022-01-06 02:00:00;230;49;1.0;1.0;QUA;Visual;8
7;7;2022-01-05 23:10:00;2022-01-05 23:50:00;230;49;1.0;1.0;QUA;Visual;11
8;8;2022-01-05 23:20:00;2022-01-06 00:20:00;230;49;1.0;1.0;QUA;Visual;13
9;4;2000-02-29 05:00:00;2000-02-29 06:00:00;10;10;1.0;1.0;GEM;Visual;2
10;999;2022-01-07 01:00:00;2022-01-07 02:00:00;1;1;1;1;QUA;Visual;100
1;1;2022-01-03 21:15:30;2022-01-03 22:16:01;230;49;1.0;1.0;QUA;Visual;30
12;5;2022-06-30 06:50:00;2022-06-30 07:50:00;338;-1;1.0;1.0;ETA;Visual;3
"""

_BINS = ["Mag N6", "Mag N5", "Mag N4", "Mag N3", "Mag N2", "Mag N1", "Mag 0", "Mag 1", "Mag 2", "Mag 3", "Mag 4",
         "Mag 5", "Mag 6"]


def _mag(mid, sid, start, end, shower, counts: dict):
    cells = [counts.get(b, "0") for b in _BINS]
    return ";".join([str(mid), str(sid), start, end, shower] + [str(c) for c in cells])


MAGNITUDES = "Magnitude ID;Obs Session ID;Start Date;End Date;Shower;" + ";".join(_BINS) + "\n" + "\n".join([
    # QUA 2022: 20 x 1, 20 x 2, 11 x 3 = 51 meteors, mean 93/51 = 1.82
    _mag(1, 1, "2022-01-03 21:15:30", "2022-01-03 22:15:30", "QUA", {"Mag 1": 20, "Mag 2": 20, "Mag 3": 11}),
    # PER 2022: exactly 50 -> not more than 50
    _mag(2, 5, "2022-06-30 06:45:10", "2022-06-30 07:45:10", "PER", {"Mag 0": 50}),
    # ETA 2022: all zero
    _mag(3, 2, "2022-01-04 22:00:00", "2022-01-04 23:00:00", "ETA", {}),
    # QUA 2022 with a null cell: the whole row drops out of both sums
    _mag(4, 3, "2022-07-01 03:30:00", "2022-07-01 04:30:00", "QUA", {"Mag 1": "", "Mag 2": 100}),
    # GEM 2000: outside the year slice
    _mag(5, 4, "2000-02-29 05:00:00", "2000-02-29 06:00:00", "GEM", {"Mag N1": 60}),
]) + "\n"

WEATHER = """Session ID,temperature_2m,relative_humidity_2m,apparent_temperature,precipitation,rain,snowfall,weather_code,cloud_cover,cloud_cover_low,cloud_cover_mid,cloud_cover_high
1,10.5,80,9.0,0.0,0.0,0.0,61.0,50,10,20,30
2,5.0,90,3.0,1.2,1.2,0.0,0.0,100,100,0,0
3,25.0,40,26.0,0.0,0.0,0.0,4.0,0,0,0,0
5,20.0,50,20.0,0.0,0.0,0.0,1.0,10,0,0,10
7,12.0,60,11.0,0.5,0.5,0.0,2.0,30,0,0,30
8,12.5,60,11.5,0.5,0.5,0.0,3.0,30,0,0,30
"""

WEATHER_CODES = """code,description
0,Clear sky
1,Mainly clear
2,Partly cloudy
3,Overcast
51,Drizzle (light intensity)
53,Drizzle (moderate intensity)
61,Rain (slight intensity)
63,Rain (moderate intensity)
"""

# only the code and the name of a shower are used; the other list columns stay empty
SHOWERS = """IAU_code,name,start,end,peak,RA,DE,V,r,ZHR,_id
QUA,Quadrantids,,,,,,,,,
PER,Perseids,,,,,,,,,
GEM,Geminids,,,,,,,,,
ETA,η-Aquariids,,,,,,,,,
LYR,April Lyrids,,,,,,,,,
"""

LOCATIONS = """Latitude,Longitude,City,Village_or_Hamlet,County,State,Country,CountryCode
-22.9,-43.2,Rio De Janeiro,Unknown,Unknown,Rio De Janeiro,Brazil,BR
59.9,10.7,Oslo,Unknown,Unknown,Oslo,Norway,NO
38.7,-9.1,Lisbon,Unknown,Lisboa,Lisboa,Portugal,PT
"""

ADDRESSES = """Latitude,Longitude,city,town,village,hamlet,county,state,country,country_code
37.9,23.7,Athína,,,,Central Athens,Attica,Ελλάδα,gr
39.9,116.4,,Dongcheng,,,,Beijing,China,cn
10.0,10.0,,,,o'hara  village,,,nowhere-land,xx
"""

FILES = {
    "sessions/part-2022.csv": SESSIONS,
    "rates/part-2022.csv": RATES,
    "magnitudes/part-2022.csv": MAGNITUDES,
    "weather/part-2022.csv": WEATHER,
    "weather_codes.csv": WEATHER_CODES,
    "showers.csv": SHOWERS,
    "locations.csv": LOCATIONS,
    "addresses.csv": ADDRESSES,
}


def write(root: str) -> dict[str, str]:
    for rel, text in FILES.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w", encoding="utf-8") as f:
            f.write(text)
    return {
        "sessions": os.path.join(root, "sessions"), "rates": os.path.join(root, "rates"),
        "magnitudes": os.path.join(root, "magnitudes"), "weather": os.path.join(root, "weather"),
        "weather_codes": os.path.join(root, "weather_codes.csv"), "showers": os.path.join(root, "showers.csv"),
        "locations": os.path.join(root, "locations.csv"), "addresses": os.path.join(root, "addresses.csv"),
    }
