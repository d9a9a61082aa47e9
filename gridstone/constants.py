"""Fixed values. Everything here is a published constant or a business threshold
that must hold exactly for results to be right; nothing is derived at run time."""

# --- Area of interest: inclusive bounding box in degrees --------------------------
BBOX = {"lat_min": 53.35, "lat_max": 53.45, "lon_min": -2.20, "lon_max": -2.05}

# --- WGS84 and Airy 1830 ellipsoids (semi-axes, metres) ---------------------------
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
AIRY_A = 6377563.396
AIRY_B = 6356256.909

# --- OSGB36 -> WGS84 position-vector transformation (EPSG:1314) -------------------
HELMERT_TRANSLATION_M = (446.448, -125.157, 542.06)
HELMERT_ROTATION_ARCSEC = (0.15, 0.247, 0.842)
HELMERT_SCALE_PPM = -20.489

# --- British National Grid (EPSG:27700) transverse Mercator -----------------------
GRID_SCALE = 0.9996012717
GRID_LAT0 = 49.0
GRID_LON0 = -2.0
GRID_FALSE_EASTING = 400000.0
GRID_FALSE_NORTHING = -100000.0

# --- Analysis grids and search radii (metres) -------------------------------------
ASSET_CELL_M = 1000
INCIDENT_CELL_M = 500
ASSET_PLACE_RADIUS_M = 2000
INCIDENT_PLACE_RADIUS_M = 1000

# --- Scored metadata fields -------------------------------------------------------
ASSET_METADATA_FIELDS = ("operator", "name", "substance", "material")
ASSET_REPORTED_FIELDS = ("operator", "name", "substance", "material", "diameter", "location")
PLACE_ADMIN_FIELDS = (
    "admin_district", "admin_ward", "parish", "region", "country", "parliamentary_constituency",
)

# --- Feature selection: (kind, element type, tag key, tag value) ------------------
FEATURE_RULES = (
    ("manhole", "node", "man_made", "manhole"),
    ("pipeline", "way", "man_made", "pipeline"),
    ("power_cable", "way", "power", "cable"),
    ("cable", "way", "man_made", "cable"),
    ("duct", "way", "man_made", "duct"),
    ("utility_pole", "node", "power", "pole"),
)

# --- Infrastructure types counted per postcode ------------------------------------
COUNTED_TYPES = ("power", "communication", "water", "gas", "sewerage", "fuel")
# The types the feature rules actually produce.
OBSERVED_TYPES = ("pole", "manhole", "pipeline", "cable", "duct", "unknown")
DIVERSITY_MAX_TYPES = 6.0

# --- Incident groups: output prefix, substring searched in category, severity -----
INCIDENT_GROUPS = (
    ("violence", "violence", 3.0),
    ("burglary", "burglary", 2.0),
    ("vehicle_crime", "vehicle", 2.0),
    ("theft", "theft", 1.0),
    ("drugs", "drugs", 1.5),
    ("antisocial", "antisocial", 1.0),
)
# Same groups with the substrings the feed really uses.
INCIDENT_GROUPS_FEED = (
    ("violence", "violent", 3.0),
    ("burglary", "burglary", 2.0),
    ("vehicle_crime", "vehicle", 2.0),
    ("theft", "theft", 1.0),
    ("drugs", "drugs", 1.5),
    ("antisocial", "anti-social", 1.0),
)

# --- Quality gates: metric, comparison, limit -------------------------------------
QUALITY_GATES = (
    ("coordinate_completeness", ">=", 0.90),
    ("projection_success", ">=", 0.95),
    ("bbox_outliers", "<=", 0.05),
)

# --- Recommended actions for high-risk zones --------------------------------------
ACTION_URGENT = "URGENT: Upgrade infrastructure security and quality"
ACTION_QUALITY = "Improve infrastructure quality and monitoring"
ACTION_SECURITY = "Enhance security measures in crime hotspot"
ACTION_ROUTINE = "Regular monitoring and maintenance"
