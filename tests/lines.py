"""Hand-written lines, one per rule about bad input, and what they count for."""


def line(names, stamp="20150219000000", fields=27, record_id=None):
    parts = [""] * fields
    parts[0], parts[1] = record_id or f"{stamp}-0", stamp
    if fields > 23:
        parts[23] = names
    return "\t".join(parts)


LINES = {
    "normal": line("Ann Lee,5;Bob Ray,9;Ann Lee,40", "20150218230000"),
    "trailing": line("Bob Ray,3;;", "20150218231500"),
    "interior": line("Ann Lee,1;;Cy Dow,2", "20150218231500"),
    "just_enough": line("Bob Ray,1", fields=24),
    "short": line("", fields=23),
    "no_names": line(""),
    "separators": line(";;"),
    "comma": line(","),
    "stopped": line("Read Full,1;Read Full Blog,2;Cy Dow,3"),
    "bad_date": line("Ann Lee,1", "20151332000000"),
    "quoted": line('"Dee" Poe,1'),
}

DAILY = {
    ("2015-02-18", "Ann Lee"): 3,
    ("2015-02-18", "Bob Ray"): 2,
    ("2015-02-18", ""): 1,
    ("2015-02-18", "Cy Dow"): 1,
    ("2015-02-19", ""): 1,
    ("2015-02-19", '"Dee" Poe'): 1,
    ("2015-02-19", "Bob Ray"): 1,
    ("2015-02-19", "Cy Dow"): 1,
}
DAILY_KEEP_EMPTY = {**DAILY, ("2015-02-18", ""): 3, ("2015-02-19", ""): 4}


def frame(spark, *names):
    chosen = names or LINES
    return spark.createDataFrame([(LINES[name],) for name in chosen], "value string")
