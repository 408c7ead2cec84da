"""Entity schemas of the music-business data model.

Ids are strings in the entity model (records arrive as JSON documents). The
views built from the driver's test tables keep numeric ids, which join and
sort faster; every operator is type-agnostic about key columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Entity field lists of the data model, in declaration order.
ENTITY_DDL = {
    "customer": "id string, type string, gender string, fname string, mname string, lname string, "
                "fullname string, suffix string, title string, birthdt string, joindt string",
    "address": "id string, customerid string, formatcode string, type string, line1 string, line2 string, "
               "citynm string, state string, zip5 string, zip4 string, countrycd string, "
               "latitude double, longitude double",
    "email": "id string, customerid string, email string",
    "phone": "id string, customerid string, phonetypecd string, primaryind string, timezone string, "
             "extnbr string, number string",
    "artist": "id string, name string, genre string",
    "event": "id string, artistid string, venueid string, capacity int, eventdate string",
    "stream": "id string, customerid string, artistid string, streamtime string",
    "ticket": "id string, customerid string, eventid string, price double",
    "venue": "id string, addressid string, name string, maxcapacity int",
}

# Input topic names of the data model (source names for the
# streaming readers), and the legacy customer topic merged by the target filter.
TOPICS = {
    "address": "data-demo-addresses",
    "artist": "data-demo-artists",
    "customer": "data-demo-customers",
    "email": "data-demo-emails",
    "event": "data-demo-events",
    "phone": "data-demo-phones",
    "stream": "data-demo-streams",
    "ticket": "data-demo-tickets",
    "venue": "data-demo-venues",
    "legacy_customer": "data-demo-legacy-customers",
}


def schema(entity: str, with_pos: bool = False) -> T.StructType:
    """StructType for an entity; ``with_pos`` appends the arrival-order column."""
    ddl = ENTITY_DDL[entity]
    if with_pos:
        ddl += ", pos bigint"
    return T._parse_datatype_string(ddl)


def ddl(entity: str, with_pos: bool = False) -> str:
    return ENTITY_DDL[entity] + (", pos bigint" if with_pos else "")
