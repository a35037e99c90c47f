"""The electric-vehicle registration table, as one contract instance."""

from ledgerline.contract import ColumnSpec, Contract

# The source keys, table columns, kinds and limits of the published
# table. They must equal the source's own names and limits for results to match.
VEHICLES = Contract(
    name="electric_vehicles",
    comment="Electric vehicle population data for the state of Washington",
    cluster_by=("STATE", "COUNTY", "CITY"),
    columns=(
        ColumnSpec("sid", "SID", length=50),
        ColumnSpec("id", "ID", length=50),
        ColumnSpec("position", "POSITION", "int", precision=10),
        ColumnSpec("created_at", "CREATED_AT", "epoch"),
        ColumnSpec("updated_at", "UPDATED_AT", "epoch"),
        ColumnSpec("VIN (1-10)", "VIN_1_10", length=10),
        ColumnSpec("Model Year", "MODEL_YEAR", "int", precision=4),
        ColumnSpec("Make", "MAKE", length=50),
        ColumnSpec("Model", "MODEL", length=100),
        ColumnSpec("Electric Vehicle Type", "ELECTRIC_VEHICLE_TYPE", length=100),
        ColumnSpec("Electric Range", "ELECTRIC_RANGE", "int", precision=10),
        ColumnSpec("Base MSRP", "BASE_MSRP", "decimal", precision=12, scale=2),
        ColumnSpec("County", "COUNTY", length=50),
        ColumnSpec("City", "CITY", length=100),
        ColumnSpec("State", "STATE", length=2),
        ColumnSpec("Postal Code", "POSTAL_CODE", length=10),
        ColumnSpec("Vehicle Location", "VEHICLE_LOCATION", "point"),
        ColumnSpec(
            "Clean Alternative Fuel Vehicle (CAFV) Eligibility",
            "CLEAN_ALTERNATIVE_FUEL_VEHICLE_CAFV_ELIGIBILITY",
            length=200,
        ),
        ColumnSpec("Legislative District", "LEGISLATIVE_DISTRICT", "int", precision=3),
        ColumnSpec("DOL Vehicle ID", "DOL_VEHICLE_ID", length=50),
        ColumnSpec("Electric Utility", "ELECTRIC_UTILITY", length=500),
        ColumnSpec("2020 Census Tract", "2020_CENSUS_TRACT", length=20),
        ColumnSpec("Counties", "COUNTIES", "int", precision=10),
        ColumnSpec("Congressional Districts", "CONGRESSIONAL_DISTRICTS", "int", precision=3),
        ColumnSpec(
            "WAOFM - GIS - Legislative District Boundary",
            "WAOFM___GIS___LEGISLATIVE_DISTRICT_BOUNDARY",
            "int",
            precision=10,
        ),
    ),
)
