"""Hand-written raw request rows (source header names), covering the edge cases."""

from __future__ import annotations

import csv
import io
import os

HEADERS = [
    "Unique Key", "Created Date", "Closed Date", "Agency", "Agency Name",
    "Problem (formerly Complaint Type)", "Problem Detail (formerly Descriptor)", "Additional Details",
    "Facility Type", "Resolution Description", "Park Facility Name", "Location Type", "Road Ramp",
    "Bridge Highway Segment", "Status", "Resolution Action Updated Date", "Borough", "Incident Zip",
    "Taxi Company Borough", "City", "Incident Address", "Latitude", "Longitude", "Location",
]

# key, created, closed, agency, agency name, type, detail, additional, status, updated, borough, zip, lat, lon
_ROWS = [
    (1, "01/05/2026 10:00:00 AM", "01/05/2026 12:30:00 PM", "HSG", "Housing", "ELEVATOR", "N/A", "None",
     "Closed", "01/05/2026 12:30:00 PM", "NORTH", "00083", "40.8", "-73.9"),
    (2, "01/05/2026 11:00:00 AM", "01/05/2026 11:00:00 AM", "HSG", "Housing", "Elevator", "NA", "",
     "Closed", "01/05/2026 11:00:00 AM", "NORTH", "10451", "40.8", "-73.9"),
    (3, "01/06/2026 09:00:00 AM", "01/06/2026 09:00:18 AM", "ENV", "Environment", "PLUMBING", "NULL", "NaN",
     "Closed", "01/06/2026 09:00:18 AM", "SOUTH", "11201", "40.6", "-73.9"),
    (4, "01/06/2026 01:00:00 PM", "", "ENV", "Environment", "Plumbing", "Leak", "",
     "Closed", "", "SOUTH", "11201", "40.6", "-73.9"),
    (5, "01/07/2026 02:00:00 PM", "01/07/2026 03:00:00 PM", "POL", "Police", "Noise", "Loud", "",
     "Pending", "01/07/2026 03:00:00 PM", "EAST", "", "40.7", "-73.8"),
    (6, "01/07/2026 05:00:00 PM", "01/07/2026 04:00:00 PM", "POL", "Police", "Noise", "Loud", "",
     "Closed", "01/07/2026 04:00:00 PM", "EAST", "11368", "40.7", "-73.8"),
    (7, "garbage", "01/08/2026 04:00:00 PM", "POL", "Police", "Noise", "Loud", "",
     "Closed", "01/08/2026 04:00:00 PM", "EAST", "11368", "40.7", "-73.8"),
    (8, "1/2/2026 1:04:05 PM", "", "TRN", "Transportation", "Street Light", "Out", "",
     "Open", "", "WEST", "10001", "40.75", "-73.99"),
    (9, "01/09/2026 12:00:00 AM", "01/09/2026 01:00:00 AM", "TRN", "Transportation", "Street Light", "Out", "",
     "Closed", "01/09/2026 01:00:00 AM", "WEST", "10001", "", "-73.99"),
    (10, "01/09/2026 06:00:00 AM", "01/09/2026 07:00:00 AM", "TRN", "TRN (old name)", "Street Light", "Out", "",
     "Closed", "01/09/2026 07:00:00 AM", "WEST", "10001", "", ""),
    (11, "01/10/2026 08:00:00 AM", "01/10/2026 09:00:00 AM", "TRN", "Transportation", "Pothole", "Hole", "",
     "Closed", "01/10/2026 09:00:00 AM", "Unspecified", "", "", ""),
    (12, "01/10/2026 08:30:00 AM", "01/10/2026 09:30:00 AM", "TRN", "Transportation", "Pothole", "Hole", "",
     "Closed", "01/10/2026 09:30:00 AM", "", "10002", "40.71", "-73.99"),
    (13, "01/11/2026 03:00:00 PM", "01/11/2026 05:00:00 PM", "SAN", "Sanitation", "Dirty", "Litter", "",
     "", "01/11/2026 05:00:00 PM", "HARBOR", "10301", "40.6", "-74.1"),
    (14, "01/12/2026 07:00:00 PM", "01/12/2026 08:00:00 PM", "SAN", "Sanitation", "Dirty", "Litter", "",
     "Closed", "01/12/2026 08:00:00 PM", "HARBOR", "10301", "40.6", "-74.1"),
    (14, "01/12/2026 07:00:00 PM", "01/12/2026 08:00:00 PM", "SAN", "Sanitation", "Dirty", "Litter", "",
     "Closed", "01/12/2026 08:00:00 PM", "HARBOR", "10301", "40.6", "-74.1"),
    (15, "01/13/2026 07:00:00 PM", "01/13/2026 08:00:00 PM", "SAN", "Sanitation", "Dirty", "Litter", "",
     "Closed", "01/13/2026 08:00:00 PM", "HARBOR", "10301", "40.6", "-74.1"),
    (15, "01/13/2026 07:00:00 PM", "01/13/2026 09:00:00 PM", "SAN", "Sanitation", "Dirty", "Litter", "",
     "Closed", "01/13/2026 09:00:00 PM", "HARBOR", "10301", "40.6", "-74.1"),
    (16, "01/14/2026 10:00:00 AM", "01/14/2026 11:00:00 AM", "", "", "  ", "x", "",
     "Closed", "01/14/2026 11:00:00 AM", "NORTH", "10451", "40.8", "-73.9"),
    (17, "01/14/2026 11:00:00 AM", "", "HSG", "Housing", "", "y", "",
     "Assigned", "", "NORTH", "10451", "40.8", "-73.9"),
]


def raw_csv_text() -> str:
    buf = io.StringIO()
    w = csv.writer(buf, lineterminator="\n")
    w.writerow(HEADERS)
    for (key, created, closed, agency, name, ctype, detail, extra, status, updated, borough, zipc, lat, lon) in _ROWS:
        row = {h: "" for h in HEADERS}
        row.update({
            "Unique Key": str(key), "Created Date": created, "Closed Date": closed, "Agency": agency,
            "Agency Name": name, "Problem (formerly Complaint Type)": ctype,
            "Problem Detail (formerly Descriptor)": detail, "Additional Details": extra, "Status": status,
            "Resolution Action Updated Date": updated, "Borough": borough, "Incident Zip": zipc,
            "Latitude": lat, "Longitude": lon, "City": "METRO" if borough else "",
        })
        w.writerow([row[h] for h in HEADERS])
    return buf.getvalue()


def write_raw_csv(directory: str) -> str:
    path = os.path.join(directory, "raw.csv")
    with open(path, "w") as fh:
        fh.write(raw_csv_text())
    return path


ROW_COUNT = len(_ROWS)
