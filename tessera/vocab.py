"""Closed vocabularies and constants of the data model. Fixed values, in their order."""

TECH_DOMAINS = (
    "LLM", "Multimodal", "RAG", "Agent", "Reasoning", "Training/Finetuning", "Inference/Serving",
    "Infra/MLOps", "Eval/Governance", "Safety/Alignment", "Data/Synthetic", "Embodied/Robotics", "Hardware/Chip", "Application/Product",
)
RELEASE_TYPES = (
    "Paper", "ProductLaunch", "OpenSource", "Policy/Regulation", "Funding/M&A", "Benchmark/Report", "Community/Discussion", "Partnership/Contract",
)
#: Severities by rank.
SEVERITIES = ("info", "warning", "critical")
#: Slots of the completeness rubric, and the verdicts on their elements.
SLOTS = ("①사건", "②범위", "③정도", "④경위")
VERDICTS = ("담김", "이름만", "없음")
PLACEHOLDER = "<<채워주세요>>"

TEXT_MAX = 4000
LOOKBACK_DAYS, OVERLAP_DAYS, MAX_LOOKBACK_DAYS, UNDATED_MAX = 7, 1, 14, 5
BREAKER_AT, QUARANTINE_AT, BACKLOG_HEAD, ALIAS_ARTICLES = 3, 2, 5, 3
GATE_CEILING, EXTRACT_CEILING = 200, 100
RUN_INTERVAL_HOURS, CLOSED_KEEP, LOOKBACK_RUNS = 24, 50, 60
FIELD_ACCURACY_AT, FAITHFULNESS_AT = 0.90, 4.0
