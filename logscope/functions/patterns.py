"""The log line grammars.

These regular expressions, time formats and unit names must equal the ones the
log corpus is defined by, so they are stated here as plain text, together.
All of them use only the common subset of Java regex and RE2
(``\\d \\b \\s \\S (?: ) (?i)``, no look-around), so the DuckDB oracle runs them verbatim.
"""

# --- fixed values: log levels -------------------------------------------------
LEVELS = ("INFO", "WARN", "ERROR", "DEBUG")            # closed domain, report order
LEVEL_WORD = r"(?i)\b(INFO|WARN|ERROR|DEBUG)\b"         # implemented form: any case, whole word
LEVEL_PLAIN = r"(INFO|WARN|ERROR|DEBUG)"                # documented form: case-sensitive, anywhere

# --- fixed values: identities in the directory layout --------------------------
APPLICATION_ID = r"(application_\d+_\d+)"
CLUSTER_ID = r"application_(\d+)_\d+"
APP_NUMBER = r"application_\d+_(\d+)"
CONTAINER_ID = r"(container_\d+_\d+_\d+_\d+)"
CONTAINER_PARTS = r"container_\d+_\d+_(\d+)_(\d+)"      # group 1 attempt, group 2 container number
AM_CONTAINER_NO = "000001"                              # the ApplicationMaster container

# --- fixed values: timestamps --------------------------------------------------
TS_ANY = r"(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}(?:,\d{3})?|\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(?:,\d{3})?)"
TS_ANCHORED = r"^(\d{2}/\d{2}/\d{2} \d{2}:\d{2}:\d{2})"
# a line that opens a log entry (anything else continues the previous entry)
ENTRY_HEADER = r"^(\d{2}/\d{2}/\d{2}|\d{4}-\d{2}-\d{2}) \d{2}:\d{2}:\d{2}"

# --- fixed values: record parse --------------------------------------------------
COMPONENT = r"(INFO|WARN|ERROR|DEBUG)\s+([^:]+):"       # group 2

# --- fixed values: message grammars ----------------------------------------------
EXECUTOR_REQUEST = (r"Will request (\d+) executor containers, each with (\d+) cores and "
                    r"(\d+) MB memory(?: including (\d+) MB overhead)?")
CONTAINER_REQUEST = r"Container request \(host: ([^,]+), capability: <memory:(\d+), vCores:(\d+)>\)"
TASK_EVENT = r"(Running|Finished) task (\d+)\.(\d+) in stage (\d+)\.(\d+) \(TID (\d+)\)"
INPUT_SPLIT = r"Input split: (\S+):(\d+)\+(\d+)"
WORKER_TIMES = r"Times: total = (-?\d+), boot = (-?\d+), init = (-?\d+), finish = (-?\d+)"
MEMORY_CAPACITY = r"MemoryStore started with capacity ([\d.]+) (B|KB|MB|GB|TB)"
STORED_BLOCK = (r"Block (\S+) stored as (bytes|values) in memory \(estimated size ([\d.]+) "
                r"(B|KB|MB|GB|TB), free ([\d.]+) (B|KB|MB|GB|TB)\)")
BROADCAST_READ = r"Started reading broadcast variable (\d+)"
RDD_BLOCK = r"^rdd_(\d+)_(\d+)$"
CACHE_HIT = r"Found block (\S+) (locally|remotely)"
SHUFFLE_FETCH = r"Started (\d+) remote fetches in (\d+) ms"
HOST = r"(mesos-(?:slave|master)-\d+|10\.10\.34\.\d+)"

# literal prefilters: a cheap substring test before each costly regex
EXECUTOR_REQUEST_HINT = "Will request "
CONTAINER_REQUEST_HINT = "Container request ("
TASK_EVENT_HINT = " task "
INPUT_SPLIT_HINT = "Input split: "
WORKER_TIMES_HINT = "Times: total = "
MEMORY_CAPACITY_HINT = "MemoryStore started with capacity "
STORED_BLOCK_HINT = " stored as "
BROADCAST_READ_HINT = "Started reading broadcast variable "
CACHE_HIT_HINT = "Found block "
SHUFFLE_FETCH_HINT = " remote fetches in "
HOST_HINTS = ("mesos-", "10.10.34.")

# parts of a line that vary from one message to the next, in the order they are masked
SHAPE_MASKS = ((r"(?:/[A-Za-z_][A-Za-z0-9_.-]*){2,}", "<path>"), (r"\b(?:0x[0-9a-fA-F]+|[0-9a-f]{16,})\b", "<hex>"),
               (r"\d+(?:[.:,/-]\d+)*", "<n>"))

# size units (binary multiples)
UNIT_EXPONENT = {"B": 0, "KB": 1, "MB": 2, "GB": 3, "TB": 4}
