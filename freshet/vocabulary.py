"""Tag vocabularies and display names."""

from __future__ import annotations

# The tag values and names that the analyses are defined by.

BUILDING = (
    "yes", "apartments", "industrial", "commercial", "retail", "residential",
    "civic", "house", "policlinic", "hotel", "stadium", "church", "government",
    "hospital", "school", "college", "fire_station", "university", "monastery",
    "public", "office", "terminal", "castle", "ruins", "garage", "garages",
    "shed", "barracks", "bungalow", "cabin", "detached", "annexe", "dormitory",
    "farm", "ger", "boathouse", "semidetached_house", "static_caravan",
    "stilt_house", "terrace", "tree_house", "trullo", "kiosk", "supermarket",
    "warehouse", "religious", "cathedral", "chapel", "military", "houseboat",
    "kingdom_hall", "mosque", "presbytery", "shrine", "synagogue", "temple",
    "bakehouse", "bridge", "clock_tower", "gatehouse", "kindergarten", "museum",
    "toilets", "train_station", "barn", "conservatory", "cowshed",
    "farm_auxiliary", "greenhouse", "slurry_tank", "stable", "sty", "livestock",
    "grandstand", "pavilion", "riding_hall", "sports_hall", "sports_centre",
    "allotment_house", "hangar", "hut", "carport", "parking", "digester",
    "service", "tech_cab", "transformer_tower", "water_tower", "storage_tank",
    "silo", "beach_hut", "bunker", "construction", "container", "guardhouse",
    "outbuilding", "pagoda", "quonset_hut", "roof", "ship", "tent", "tower",
    "triumphal_arch", "windmill",
)

HIGHWAY = (
    "motorway", "trunk", "primary", "secondary", "tertiary", "residential",
    "motorway_link", "trunk_link", "primary_link", "secondary_link",
    "tertiary_link", "living_street", "busway", "footway", "cycleway",
)

RAILWAY = ("light_rail", "monorail", "rail", "subway", "tram")

#: In order of priority: the first key that matches names a feature.
TRANSPORT = {"highway": HIGHWAY, "railway": RAILWAY}

CRITICAL = {
    "aeroway": ("runway",),
    "amenity": ("college", "university", "doctors", "hospital", "fire_station", "police", "townhall"),
    "building": ("college", "fire_station", "government", "hospital", "school", "university", "military"),
    "man_made": ("water_works", "water_well"),
    "military": ("airfield", "base"),
    "power": ("plant",),
    "waterway": ("dam",),
}

STRUCTURES = {
    "aeroway": (
        "aerodrome", "aircraft_crossing", "apron", "gate", "hangar", "helipad",
        "heliport", "navigationaid", "runway", "spaceport", "taxiway", "terminal",
    ),
    "amenity": (
        "bar", "biergarten", "cafe", "fast_food", "food_court", "ice_cream", "pub", "restaurant",
        "college", "dancing_school", "driving_school", "first_aid_school", "kindergarten",
        "language_school", "library", "surf_school", "toy_library", "research_institute",
        "training", "music_school", "school", "traffic_park", "university",
        "bicycle_rental", "bicycle_wash", "boat_rental", "boat_storage", "boat_sharing",
        "bus_station", "car_rental", "car_sharing", "car_wash", "vehicle_inspection",
        "charging_station", "driver_training", "ferry_terminal", "fuel", "motorcycle_parking",
        "parking", "taxi", "weighbridge", "payment_terminal",
        "bank", "bureau_de_change", "money_transfer", "payment_centre",
        "clinic", "dentist", "doctors", "hospital", "nursing_home", "pharmacy",
        "social_facility", "veterinary",
        "arts_centre", "casino", "cinema", "community_centre", "conference_centre",
        "events_venue", "exhibition_centre", "fountain", "gambling", "music_venue",
        "nightclub", "planetarium", "social_centre", "stage", "studio", "swingerclub", "theatre",
        "courthouse", "fire_station", "police", "post_depot", "post_office", "prison",
        "ranger_station", "townhall",
        "check_in", "lounge", "mailroom", "waste_transfer_station", "animal_shelter",
        "animal_training", "crematorium", "dive_centre", "funeral_hall", "grave_yard",
        "internet_cafe", "marketplace", "monastery", "mortuary", "place_of_worship", "refugee_site",
    ),
    "building": (
        "apartments", "barracks", "bungalow", "cabin", "detached", "annex", "dormitory",
        "farm", "ger", "hotel", "house", "houseboat", "residential", "semidetached_house",
        "static_caravan", "stilt_house", "terrace", "trullo",
        "commercial", "industrial", "office", "retail", "supermarket", "warehouse",
        "religious", "cathedral", "chapel", "church", "kingdom_hall", "monastery",
        "mosque", "presbytery", "shrine", "synagogue", "temple",
        "bakehouse", "bridge", "civic", "clock_tower", "college", "fire_station",
        "government", "gatehouse", "hospital", "kindergarten", "museum", "public",
        "school", "toilets", "train_station", "transportation", "university",
        "barn", "conservatory", "cowshed", "farm_auxiliary", "greenhouse", "stable", "livestock",
        "grandstand", "pavilion", "riding_hall", "sports_hall", "sports_centre", "stadium",
        "allotment_house", "boathouse", "hangar", "hut", "shed", "carport", "garage",
        "garages", "parking", "digester", "service", "tech_cab", "transformer_tower",
        "water_tower", "storage_tank", "silo",
        "beach_hut", "castle", "guardhouse", "military", "outbuilding", "pagoda",
        "quonset_hut", "ruins", "ship", "tower", "windmill",
    ),
}

DISPLAY_NAMES = {
    "amenity": "Amenities",
    "building": "Buildings",
    "aeroway": "Airport Infrastructure",
    "highway": "Road Infrastructure",
    "railway": "Railway Infrastructure",
    "shop": "Shops & Retail",
    "tourism": "Tourism Facilities",
    "leisure": "Leisure Facilities",
    "office": "Office Buildings",
    "landuse": "Land Use Areas",
    "natural": "Natural Features",
    "waterway": "Waterways",
    "power": "Power Infrastructure",
    "man_made": "Man-made Structures",
    "craft": "Craft Facilities",
    "emergency": "Emergency Services",
    "healthcare": "Healthcare Facilities",
    "historic": "Historic Sites",
    "military": "Military Facilities",
    "sport": "Sports Facilities",
    "telecom": "Telecom Infrastructure",
    "public_transport": "Public Transport",
}

CROPLAND = 40
#: km2 of one land-cover pixel of 10 m.
PIXEL_KM2 = 0.0001
