"""Category lists, the acre factor and the WGS84 spheroid."""

# Account types counted as residential and as commercial (MIXED USE is both).
RESIDENTIAL_TYPES = ("APARTMENT", "MIXED USE", "RESIDENT LAND", "RESIDENTIAL", "RESIDENTIAL CONDO")
COMMERCIAL_TYPES = ("BED & BREAK", "COMMERCIAL", "MIXED USE")

# Account numbers of real property start with this letter; others are buildings.
REAL_ACCOUNT_PREFIX = "R"

# Acres per square metre as the published figures use it (rounded, on purpose).
ACRES_PER_M2 = 0.00024711

# Snapshot ids and the report date derived from them.
SNAPSHOT_FORMAT = "yyyyMMdd"

# File names inside one landed snapshot folder.
OWNER_FILE = "Owner_Address.csv"
PARCEL_FILE = "Parcels/Parcels.shp"

# WGS84 spheroid: semi-major axis in metres and squared eccentricity.
WGS84_A = 6378137.0
WGS84_E2 = 0.0066943799901413165
