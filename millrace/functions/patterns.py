"""Patterns and tables of the indicators."""

# What tools print, what a build step never runs, address ranges.
PRIVATE_IP = r"^(10\.)|^(192\.168\.)|^(172\.(1[6-9]|2[0-9]|3[0-1])\.)|^(127\.)"
SIGNATURES = [
    ("ice", r"(?i)(internal compiler error|segmentation fault|sigsegv|stack dump:|please submit a full bug report)"),
    ("oom", r"(?i)(out of memory|\bkilled\b|oomkilled|cannot allocate memory|java\.lang\.outofmemoryerror)"),
    ("disk_full", r"(?i)(no space left on device|disk quota exceeded)"),
    ("checksum_mismatch", r"(?i)(checksum mismatch|sha-?256 mismatch|digest mismatch|corrupt(ed)? (cache|archive|entry)|unexpected end of archive)"),
]
ROGUE_COMMAND = (
    r"(?i)(\bxmrig\b|\bminerd\b|stratum\+tcp|\bnc\s+-e\b|/dev/tcp/|bash\s+-i\s*>&|(curl|wget)\s+[^|]*\|\s*(ba)?sh"
    r"|base64\s+-d\s*\|\s*(ba)?sh|printenv\s*\|\s*(curl|nc)|\.aws/credentials|id_rsa|chmod\s+\+x\s+/tmp|history\s+-c)"
)
ROGUE_FILE = r"(/\.ssh/id_|/\.aws/credentials|^/etc/(shadow|passwd)$)"
REVERSE_SHELL = r"(?i)(\bnc\s+-e\b|/dev/tcp/|bash\s+-i\s*>&)"
UNTRUSTED_FETCH = r"(?i)(^/(unofficial|unverified|snapshots-unsigned)/|\.(sh|exe|bat|ps1)(\?|$)|\.\./)"
UUID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
#: Address prefix (two octets) to region; "--" has none by design, an unknown prefix has "".
REGIONS = [("192.168", "--"), ("10.0", "--"), ("172.16", "--"), ("127.0", "--"), ("102.67", "cloud-af"), ("196.200", "vendor-ma")]

#: ISO 8601 texts that are timestamps here: a date, or a date and a time with an optional fraction and zone.
ISO = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,9})?)?([zZ]|[+-]\d{2}(:?\d{2})?)?)?$"
