"""A small store feed with one row per awkward case, as CSV text."""

HEADER = (
    "appid,name,release_date,english,developer,publisher,platforms,required_age,categories,"
    "genres,tags,achievements,positive_ratings,negative_ratings,average_playtime,"
    "median_playtime,owners,price"
)

# id: (name, date, developer, platforms, genres, achievements, positive, negative, owners, price)
ROWS = {
    "10": ("Plain", "2015-03-01", "Studio A", "windows;mac;linux", "Action;Indie", "0", "90", "10", "100-200", "4.99"),
    "20": ('"He said ""hi"", then left"', "2016-07-09", '"A, ""B"" Co"', "windows", "Indie", "10", "30", "30", "0-20000", "0.0"),
    "30": ("Bad date", "bad-date", "Studio A", "windows", "Action", "11", "1", "1", "20-41", "60.0"),
    "40": ("Impossible date", "2010-02-30", "Studio A", "windows", "Action", "x", "1", "1", "10-20", "61.0"),
    "50": ("Bad price", "2015-01-01", "Studio B", "mac", "Action", "5", "50", "50", "1-2", "abc"),
    "60": ("Negative price", "2015-01-01", "Studio B", "windows;machine", "Indie", "5", "50", "0", "1-2", "-1.0"),
    "70": ("No dash", "2014-12-31", "Studio C", "linux", "Action; ", "5", "50", "0", "nodash", "10"),
    "80": ("No ratings", "2018-01-01", "", "", "", "100", "0", "0", "5-x", "19.99"),
    "90": ("   ", "2018-01-01", "Studio D", "windows", "Action", "1", "1", "1", "1-2", "1"),
    "nope": ("No id", "2018-01-01", "Studio D", "windows", "Action", "1", "1", "1", "1-2", "1"),
    "11": ("Twice", "2018-01-01", "Studio E", "windows", "Action", "1", "7", "1", "1-2", "1"),
    "11 ": ("Twice", "2018-01-01", "Studio E", "windows", "Action", "1", "5", "1", "1-2", "1"),
    "12.0": ("Fraction id", "2018-01-01", "Studio F", "windows", "RPG", "1.9", "1", "1", "1-2", "1"),
}


def store_csv() -> str:
    lines = [HEADER]
    for key, row in ROWS.items():
        name, date, developer, platforms, genres, ach, positive, negative, owners, price = row
        lines.append(
            f"{key},{name},{date},1,{developer},Pub,{platforms},0,Single;Multi,{genres},x;y,{ach},"
            f"{positive},{negative},120,60,{owners},{price}"
        )
    return "\n".join(lines) + "\n"


# Column names with a leading digit, a dot, a quote and a back quote.
TAGS_CSV = """appid,2d,360_video,co.op,it's,a`b
10,5,0,1,0,3
20,0,0,0,0,0
30,x,-2,,7,2.0
"""
