"""Fixed values. They must stay exactly as they are for results to be right."""

# Fields of an extraction record, in the order in which they are written.
RECORD_FIELDS = [
    "cancer_type",
    "stage",
    "gene_mutation",
    "biomarker",
    "treatment",
    "response",
    "metastasis_site",
]

# Scalar tags kept for analysis.
CORE_TAGS = ["train/loss", "eval/loss", "train/learning_rate", "train/epoch"]

TRAIN_LOSS = "train/loss"
EVAL_LOSS = "eval/loss"
LEARNING_RATE = "train/learning_rate"
EPOCH = "train/epoch"

# Chat template.
BEGIN_OF_TEXT = "<|begin_of_text|>"
SYSTEM_HEADER = "<|start_header_id|>system<|end_header_id|>\n\n"
USER_HEADER = "<|start_header_id|>user<|end_header_id|>\n\n"
ASSISTANT_MARKER = "<|start_header_id|>assistant<|end_header_id|>"
END_OF_TURN = "<|eot_id|>"
SYSTEM_PROMPT = (
    "You are a medical information extraction assistant. "
    "Extract structured cancer-related entities from clinical text."
)

# Plain prompt used when a trained model is tried out.
INFERENCE_INSTRUCTION = "Extract all cancer-related entities from the text."
INFERENCE_SUFFIX = "Output (JSON format):\n"

# What a prediction that is not JSON is replaced with.
PARSE_ERROR = "Failed to parse JSON"

# Files a finished run must hold.
REQUIRED_ADAPTER_FILES = ["adapter_config.json", "adapter_model.safetensors"]

# Label value that the loss ignores.
IGNORED_LABEL = -100

# Generation parameters.
GENERATION_PARAMS = {"max_new_tokens": 512, "temperature": 0.1, "top_p": 0.95}
