"""Reference inputs and expected results (see FIXTURES.md)."""

from datetime import datetime, timezone


def ms(y, mo, d, h, mi, s):
    return int(datetime(y, mo, d, h, mi, s, tzinfo=timezone.utc).timestamp() * 1000)


# seven clicks; F1a: the first three
CLICKS7 = [("a", "./home", 1000), ("b", "./h", 1212), ("c", "./sdf", 1231), ("b", "./ada?id=1", 2002),
           ("c", "./sdf", 3213), ("b", "./ada?id=2", 2222), ("b", "./ada?id=3", 3212)]
CLICKS3 = CLICKS7[:3]

# the SQL job's six clicks
CLICKS6 = [("Alice", "./home", 1000), ("Bob", "./cart", 1000), ("Alice", "./prod?id=1", 5000),
           ("Cary", "./home", 60000), ("Bob", "./prod?id=3", 90000), ("Alice", "./prod?id=7", 105000)]

# the word-count input file
LINES = ["hello world", "my name is lihua", "how are you", "hello java"]

# 10 s tumbling url counts, 2023-09-06
CLICKS_WINDOW = [("maliao", "/abc@a=1?", ms(2023, 9, 6, 22, 1, 52)), ("jary", "/al/a?", ms(2023, 9, 6, 22, 1, 53)),
                 ("Tom", "/b/url/afs", ms(2023, 9, 6, 22, 1, 54)), ("Tom", "/a", ms(2023, 9, 6, 22, 1, 56)),
                 ("mary", "/al/a?", ms(2023, 9, 6, 22, 1, 57)), ("liha", "/abc@a=1?", ms(2023, 9, 6, 22, 1, 58)),
                 ("maliao", "/b/url/afs", ms(2023, 9, 6, 22, 1, 59)), ("maliao", "/b", ms(2023, 9, 6, 22, 2, 0))]

# two keyed streams
LEFT_PAIRS = [("a", "stream-1", 1000), ("b", "stream-1", 2000)]
RIGHT_PAIRS = [("a", "stream-2", 1000), ("b", "stream-2", 2000)]

# the generator's value domain (non-ASCII user, '?', '@', '=' in urls)
USERS9 = ["liha", "Tom", "mary", "小明", "jary", "maliao"]
URLS9 = ["/a", "/b", "/c", "/abc@a=1?", "/al/a?", "/b/url/afs"]
