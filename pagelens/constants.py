"""Fixed values of the page model: they must stay as they are for right results."""

REGION_TYPES = ["handwritten", "printed", "formula", "table", "annotation", "image", "graph"]
TRANSCRIBED_TYPES = ["handwritten", "printed", "formula", "table", "annotation"]
EMPTY_TEXT_TYPES = ["image", "graph"]
QUALITY_WEIGHTS = {"annotator": 1.0, "volunteer": 0.75, "auto": 0.35}
DEFAULT_QUALITY_WEIGHT = 0.5
LEAST_SAMPLE_WEIGHT = 0.01
READING_ORDER_ROW_BAND = 15
DEFAULT_IOU = 0.5
DEFAULT_CONFIDENCE = 0.25
DEFAULT_MAX_PIXELS = 262144
FILES_PER_SHARD = 2000
FILES_PER_DIR = 9000
IGNORED_LABEL = -100
SPLITS = ["train", "silver", "val", "test"]

SCORE_WEIGHTS = {"f1": 0.15, "class_acc": 0.05, "cer": 0.30, "page_cer": 0.50}

REGION_STRUCT = "struct<bbox:array<int>,type:string,text:string,language:string,legibility:string,confidence:double>"
RAW_REGION = "struct<bbox:array<double>,type:string,text:string,language:string,legibility:string,confidence:double>"
RAW_PAGE = (
    "file_name string, image struct<path:string,src:string,width:int,height:int>, image_width int, image_height int, source string, "
    f"annotation_source string, year int, fund string, content_type string, grade int, subject string, `group` string, regions array<{RAW_REGION}>"
)
SFT_ROW = "id string, image string, task string, region_type string, source string, annotation_source string, quality_weight double, prompt string, answer string"
