"""Small feeds for the tests."""

from pathlib import Path

HEAD = '<?xml version="1.0" encoding="utf-8"?>\n<rss version="2.0"><channel><title>A feed</title>\n'
TAIL = "</channel></rss>\n"


def item(key, title="T", start="Tue, 07 May 2024 18:30:00 GMT", end="Tue, 07 May 2024 20:00:00 GMT",
         location="Room 1", host="Club", description="", guid=None, extra=""):
    return f"""    <item>
      <title>{title}</title>
      <guid>{guid or f"https://feed.example.org/event/{key}"}</guid>
      <link>https://feed.example.org/event/{key}</link>
      <description><![CDATA[<div class="h"><div class="p-description description">{description}</div></div>]]></description>
      <comments>https://feed.example.org/event/{key}/talk</comments>
      <start xmlns="events">{start}</start>
      <end xmlns="events">{end}</end>
      <location xmlns="events">{location}</location>
      <host xmlns="events">{host}</host>{extra}
    </item>
"""


def feed(*items):
    return HEAD + "".join(items) + TAIL


def put(folder, name, content):
    path = Path(folder) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(path)


def name(day, second=0):
    return f"events_202401{day:02d}_{second:06d}.xml"
