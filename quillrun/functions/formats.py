"""The shapes of log lines and the names of run files.

They must equal what training runs write, so they are kept as plain text here.
"""

RANK = r"\[RANK\s+(\d+)\]\s+WORLD_SIZE=(\d+)"
RENDEZVOUS = (
    r"torchrun:\s+nnodes=(\d+)\s+nproc_per_node=(\d+)\s+node_rank=(\d+)\s+rdzv=([^\s]+)"
)
SANITY = (
    r"NODE\s+(\S+)\s+OK\s+->\s+PY\s+(\S+)\s+torch\s+(\S+)\s+tfm\s+(\S+)"
    r"\s+numpy\s+(\S+)\s+datasets\s+(\S+)\s+root\s+(\S+)"
)
STEP = (
    r"\[rank\s+(\d+)\s+\|\s+step\s+(\d+)\]\s+.*?step_ms=([\d.]+)"
    r"\s+samples_per_sec=([\d.]+)\s+tokens_per_sec=([\d.]+)"
)
RUNTIME = r"TRAIN_RUNTIME_SEC=([\d.]+)"
EVALUATION = r"(?:eval_accuracy|EVAL accuracy)=\s*([0-9]*\.?[0-9]+)"
INFERENCE = (
    r"\[RANK 0\]\s+INFER.*global_accuracy=\s*([0-9]*\.?[0-9]+)"
    r".*?global_samples_per_sec=([\d.]+).*?global_tokens_per_sec=([\d.]+)"
)
FAILURE = r"(?i)(Traceback|ERROR|RuntimeError|OSError|Address already in use|Timed out)"
RANK_STEP = r"\[rank\s+(\d+)\s+\|\s+step\s+(\d+)\]"
PAIR = r"([A-Za-z_][\w.]*)=(\S+)"
PHASE = r"\[([^\]]+)\]\s+([\d.]+)\s+sec"
HOST_STEP = r"\[([^\]]+)\]\s+rank=(\d+)\s+step\s+(\d+)\s+([\d.]+)s"
PIPELINE_STEP = r"\bep=(\d+)\s+step=(\d+)\s+loss=([\d.]+|nan|inf)\s+\(\+([\d.]+)s\)"
# A dictionary as the trainer prints it: quoted keys, numbers, texts, no nesting.
DICTIONARY = r"\{'[^'{}]+':\s[^{}]*\}"

PHASES = ["Dataset load", "Tokenization", "Trainer setup", "Training", "Model save"]
TRAINING_PHASE = "Training"
PREFLIGHT_MISSING = "missing"

EXCERPT_RANKS = r"WORLD_SIZE|^\[RANK "
EXCERPT_TRAINING = (
    r"train_runtime|train_samples_per_second|train_steps_per_second|train_loss|^\[rank .* step "
)
EXCERPT_INFERENCE = r"INFER global_"

LOG_FILES = "*.{job}.*.out"
PREFLIGHT_FILE = "preflight.{job}.txt"
META_FILES = ["meta.final.json", "meta.json"]
WALL_FILE = "wallclock_seconds.txt"
TIMING_FILES = "timing_rank*.log"
TIMING_RANK = r"timing_rank(\d+)\.log$"
