"""Reference data of the supported countries.

Fixed values: region codes, names, populations, source spellings and published corrections.
They must agree with the published sources for results to be comparable.
"""

from __future__ import annotations

# Compute zones.
ZONES = ("Asia", "Europe", "America")

# Supported countries (ISO alpha-2, alpha-3, zone).
COUNTRIES = (
    ("AT", "AUT", "Europe"),
    ("BE", "BEL", "Europe"),
    ("CH", "CHE", "Europe"),
    ("CZ", "CZE", "Europe"),
    ("DE", "DEU", "Europe"),
    ("DK", "DNK", "Europe"),
    ("FR", "FRA", "Europe"),
    ("IT", "ITA", "Europe"),
    ("LU", "LUX", "Europe"),
    ("NL", "NLD", "Europe"),
    ("PT", "PRT", "Europe"),
    ("US", "USA", "America"),
)

# Countries with one national region (alpha-2, name, population).
SINGLE_REGION_COUNTRIES = (
    ("AT", "Austria", 8901064),
    ("CH", "Switzerland", 8603900),
    ("CZ", "Czech Republic", 10637794),
    ("DK", "Denmark", 5822763),
    ("LU", "Luxemburg", 626108),
    ("NL", "Netherlands", 17290688),
    ("PT", "Portugal", 10295909),
)


# German states (code, name, population). Bremen and Saarland have no regional test
# counts and are no regions of their own, but their numbers belong to the national total.
DE_REGIONS = (
    ("BB", "Brandenburg", 2521893),
    ("BE", "Berlin", 3669491),
    ("BW", "Baden-Württemberg", 11100394),
    ("BY", "Bayern", 13124737),
    ("HE", "Hessen", 6288080),
    ("HH", "Hamburg", 1847253),
    ("MV", "Mecklenburg-Vorpommern", 1608138),
    ("NI", "Niedersachsen", 7993608),
    ("NW", "Nordrhein-Westfalen", 17947221),
    ("RP", "Rheinland-Pfalz", 4093903),
    ("SH", "Schleswig-Holstein", 2903773),
    ("SN", "Sachsen", 4071971),
    ("ST", "Sachsen-Anhalt", 2194782),
    ("TH", "Thüringen", 2133378),
    ("all", "Germany", 83166711),
)
DE_UNASSIGNED = "nicht zugeordnet"


# US states (code, name, population).
US_REGIONS = (
    ("AK", "Alaska", 731545),
    ("AL", "Alabama", 4903185),
    ("AR", "Arkansas", 3017825),
    ("AZ", "Arizona", 7278717),
    ("CA", "California", 39512223),
    ("CO", "Colorado", 5758736),
    ("CT", "Connecticut", 3565287),
    ("DC", "District of Columbia", 705749),
    ("DE", "Delaware", 973764),
    ("FL", "Florida", 21477737),
    ("GA", "Georgia", 10617423),
    ("HI", "Hawaii", 1415872),
    ("IA", "Iowa", 3155070),
    ("ID", "Idaho", 1787147),
    ("IL", "Illinois", 12671821),
    ("IN", "Indiana", 6732219),
    ("KS", "Kansas", 2913314),
    ("KY", "Kentucky", 4467673),
    ("LA", "Louisiana", 4648794),
    ("MA", "Massachusetts", 6949503),
    ("MD", "Maryland", 6045680),
    ("ME", "Maine", 1344212),
    ("MI", "Michigan", 9986857),
    ("MN", "Minnesota", 5639632),
    ("MO", "Missouri", 6137428),
    ("MS", "Mississippi", 2976149),
    ("MT", "Montana", 1068778),
    ("NC", "North Carolina", 10488084),
    ("ND", "North Dakota", 762062),
    ("NE", "Nebraska", 1934408),
    ("NH", "New Hampshire", 1359711),
    ("NJ", "New Jersey", 8882190),
    ("NM", "New Mexico", 2096829),
    ("NV", "Nevada", 3080156),
    ("NY", "New York", 19453561),
    ("OH", "Ohio", 11689100),
    ("OK", "Oklahoma", 3956971),
    ("OR", "Oregon", 4217737),
    ("PA", "Pennsylvania", 12801989),
    ("RI", "Rhode Island", 1059361),
    ("SC", "South Carolina", 5148714),
    ("SD", "South Dakota", 884659),
    ("TN", "Tennessee", 6833174),
    ("TX", "Texas", 28995881),
    ("UT", "Utah", 3205958),
    ("VA", "Virginia", 8535519),
    ("VT", "Vermont", 623989),
    ("WA", "Washington", 7614893),
    ("WI", "Wisconsin", 5822434),
    ("WV", "West Virginia", 1792065),
    ("WY", "Wyoming", 578759),
)
US_EXCLUDED = ("MP", "GU", "AS", "PR", "VI")
US_CHECK_FROM = "2020-07-27"
US_CHECK_EXEMPT = ("WY", "HI")
US_MIN_STATES = 40

# US corrections (region, first day, last day or None, columns, action, value).
BOTH = ("new_cases", "new_tests")
US_CORRECTIONS = (
    ("MI", "2020-06-05", None, ("total",), "offset", -5014.0),
    ("LA", "2020-06-19", None, ("positive", "total"), "offset", 1666.0),
    ("MI", "2020-06-18", "2020-06-19", ("new_tests",), "set", 14871.0),
    ("OR", "2020-06-26", "2020-06-28", ("new_cases",), "set", 174.0),
    ("OR", "2020-06-26", "2020-06-28", ("new_tests",), "set", 3296.0),
    ("AL", "2020-07-09", "2020-07-09", BOTH, "null", None),
    ("AR", "2020-07-10", "2020-07-10", BOTH, "null", None),
    ("CA", "2020-04-22", "2020-04-22", BOTH, "null", None),
    ("CT", "2020-07-17", "2020-07-17", BOTH, "null", None),
    ("CT", "2020-07-21", "2020-07-21", BOTH, "null", None),
    ("DC", "2020-08-04", "2020-08-04", BOTH, "null", None),
    ("DE", "2020-08-14", "2020-08-14", BOTH, "null", None),
    ("HI", "2020-08-07", "2020-08-07", BOTH, "null", None),
    ("MS", "2020-07-12", "2020-07-12", BOTH, "null", None),
    ("NJ", "2020-05-11", "2020-05-11", BOTH, "null", None),
    ("NJ", "2020-07-25", "2020-07-25", BOTH, "null", None),
    ("NV", "2020-07-02", "2020-07-02", BOTH, "null", None),
    ("OH", "2020-07-01", "2020-07-01", BOTH, "null", None),
    ("OH", "2020-07-09", "2020-07-09", BOTH, "null", None),
    ("PA", "2020-04-21", "2020-04-21", BOTH, "null", None),
    ("PA", "2020-05-20", "2020-05-20", BOTH, "null", None),
    ("PA", "2020-06-03", "2020-06-03", BOTH, "null", None),
    ("SC", "2020-06-26", "2020-06-26", BOTH, "null", None),
    ("SD", "2020-08-26", "2020-08-26", BOTH, "null", None),
    ("TX", "2020-08-08", "2020-08-08", BOTH, "null", None),
    ("TX", "2020-08-11", "2020-08-11", BOTH, "null", None),
    ("WA", "2020-06-05", "2020-06-07", BOTH, "null", None),
    ("WA", "2020-06-20", "2020-06-21", BOTH, "null", None),
    ("WA", "2020-09-22", "2020-09-24", BOTH, "null", None),
)

# Austrian days with glitches in the test counts.
AT_GLITCHES = ("2020-04-02", "2020-07-20")

# French regions (code, name, short name, population as published).
FR_REGIONS = (
    ("84", "Auvergne-Rhône-Alpes", "ARA", "8 032 377"),
    ("27", "Bourgogne-Franche-Comté", "BFC", "2 783 039"),
    ("53", "Bretagne", "BRE", "3 340 379"),
    ("24", "Centre-Val-de-Loire", "CVL", "2 559 073"),
    ("94", "Corse", "COR", "344 679"),
    ("44", "Grand Est", "GES", "5 511 747"),
    ("32", "Hauts-de-France", "HDF", "5 962 662"),
    ("11", "Île-de-France", "IDF", "12 278 210"),
    ("28", "Normandie", "NOR", "3 303 500"),
    ("75", "Nouvelle-Aquitaine", "NAQ", "5 999 982"),
    ("76", "Occitanie", "OCC", "5 924 858"),
    ("52", "Pays de la Loire", "PDL", "3 801 797"),
    ("93", "Provence-Alpes-Côte d'Azur", "PAC", "5 055 651"),
    ("01", "Guadeloupe", "GP", "376 879"),
    ("02", "Martinique", "MQ", "358 749"),
    ("03", "Guyane", "GF", "290 691"),
    ("04", "La Réunion", "RE", "859 959"),
    ("06", "Mayotte", "YT", "279 471"),
)

# Belgian regions and provinces (code, name, spelling in the source, population).
BE_REGIONS = (
    ("all", "Belgium", "all", 11476279),
    ("FLA", "Vlaanderen", "Flanders", 6623505),
    ("WAL", "Wallonie", "Wallonia", 3641748),
    ("BRU", "Brussel", "Brussels", 1211026),
    ("ANT", "Antwerpen", "Antwerpen", 1867366),
    ("LIM", "Limburg", "Limburg", 876785),
    ("EFL", "Oost-Vlaanderen", "OostVlaanderen", 1524077),
    ("FBR", "Vlaams-Brabant", "VlaamsBrabant", 1155148),
    ("WFL", "West-Vlaanderen", "WestVlaanderen", 1200129),
    ("HAI", "Hainaut", "Hainaut", 1345270),
    ("LIE", "Liège", "Liège", 1108481),
    ("LUX", "Luxembourg", "Luxembourg", 286571),
    ("NAM", "Namur", "Namur", 495474),
    ("WBR", "Brabant wallon", "BrabantWallon", 405952),
)
# Order matters: the unassigned bucket is spread over the regions one after another.
BE_REDISTRIBUTION = ("Brussels", "Flanders", "Wallonia")

# Italian regions (code, name, short name, population).
IT_REGIONS = (
    ("01", "Piemonte", "PIE", 4341375),
    ("02", "Valle d'Aosta", "VAL", 125501),
    ("03", "Lombardia", "LOM", 10103969),
    ("05", "Veneto", "VEN", 4907704),
    ("06", "Friuli Venezia Giulia", "FRI", 1211357),
    ("07", "Liguria", "LIG", 1543127),
    ("08", "Emilia-Romagna", "EMI", 4467118),
    ("09", "Toscana", "TOS", 3722729),
    ("10", "Umbria", "UMB", 880285),
    ("11", "Marche", "MAR", 1518400),
    ("12", "Lazio", "LAZ", 5865544),
    ("13", "Abruzzo", "ABR", 1305770),
    ("14", "Molise", "MOL", 302265),
    ("15", "Campania", "CAM", 5785861),
    ("16", "Puglia", "PUG", 4008296),
    ("17", "Basilicata", "BAS", 556934),
    ("18", "Calabria", "CAL", 1924701),
    ("19", "Sicilia", "SIC", 4968410),
    ("20", "Sardegna", "SAR", 1630474),
    ("21", "P.A. Bolzano", "PBZ", 532080),
    ("22", "P.A. Trento", "PTN", 542739),
    ("all", "Italy", "all", 60244639),
)

# Headers of the nowcast table over the years, per canonical column.
NOWCAST_HEADERS = {
    "date": (
        "Datum des Erkrankungsbeginns",
        "Datum",
    ),
    "new_cases": (
        "PS_COVID_Faelle",
        "Punktschätzer der Anzahl Neuerkrankungen (ohne Glättung)",
    ),
    "new_cases_lower": (
        "UG_PI_COVID_Faelle",
        "Untere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen (ohne Glä",
        "Untere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen (ohne Glättung)",
    ),
    "new_cases_upper": (
        "OG_PI_COVID_Faelle",
        "Obere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen (ohne Glät",
        "Obere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen (ohne Glättung)",
    ),
    "new_cases_smooth": (
        "Punktschätzer der Anzahl Neuerkrankungen",
        "PS_COVID_Faelle_ma4",
    ),
    "new_cases_smooth_lower": (
        "UG_PI_COVID_Faelle_ma4",
        "Untere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen",
    ),
    "new_cases_smooth_upper": (
        "OG_PI_COVID_Faelle_ma4",
        "Obere Grenze des 95%-Prädiktionsintervalls der Anzahl Neuerkrankungen",
    ),
    "r4": (
        "Punktschätzer der Reproduktionszahl R",
        "Punktschätzer der 4-Tages R-Wert",
        "Punktschätzer der 4-Tage R-Wert",
        "Punktschätzer des 4-Tage-R-Wertes",
        "PS_4_Tage_R_Wert",
    ),
    "r4_lower": (
        "UG_PI_4_Tage_R_Wert",
        "Untere Grenze des 95%-Prädiktionsintervalls der Reproduktionszahl R",
        "Untere Grenze des 95%-Prädiktionsintervalls der 4-Tages R-Wert",
        "Untere Grenze des 95%-Prädiktionsintervalls der 4-Tage R-Wert",
        "Untere Grenze des 95%-Prädiktionsintervalls des 4-Tage-R-Wertes",
    ),
    "r4_upper": (
        "OG_PI_4_Tage_R_Wert",
        "Obere Grenze des 95%-Prädiktionsintervalls der Reproduktionszahl R",
        "Obere Grenze des 95%-Prädiktionsintervalls der 4-Tages R-Wert",
        "Obere Grenze des 95%-Prädiktionsintervalls der 4-Tage R-Wert",
        "Obere Grenze des 95%-Prädiktionsintervalls des 4-Tage-R-Wertes",
    ),
    "r7": (
        "PS_7_Tage_R_Wert",
        "Punktschätzer des 7-Tage-R Wertes",
        "Punktschätzer des 7-Tage-R-Wertes",
    ),
    "r7_lower": (
        "UG_PI_7_Tage_R_Wert",
        "Untere Grenze des 95%-Prädiktionsintervalls des 7-Tage-R Wertes",
        "Untere Grenze des 95%-Prädiktionsintervalls des 7-Tage-R-Wertes",
    ),
    "r7_upper": (
        "OG_PI_7_Tage_R_Wert",
        "Obere Grenze des 95%-Prädiktionsintervalls des 7-Tage-R Wertes",
        "Obere Grenze des 95%-Prädiktionsintervalls des 7-Tage-R-Wertes",
    ),
}
NOWCAST_LABELS = {"r4": "(RKI) $R_t$", "r7": "(RKI) $R_t$ 7 days"}
NOWCAST_LABELS_GERMAN = {"r4": "(RKI) $R_t$", "r7": "(RKI) $R_t$ 7 Tage"}
