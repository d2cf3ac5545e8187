"""Patterns by which claims, titles and texts are told. Case does not matter; all are fixed values."""

# They must find what the rules of the domain name.
FRONT = r"(?i)(U\.S\.\s+Patent|Sheet\s+\d+\s+of\s+\d+|cited by examiner|References Cited|Foreign Application Priority Data|Primary Examiner)"
FIGURE = r"(?i)\bFIG\.?\s*\d+[A-Z]?\b"
FIGURE_OR_FRONT = r"(?i)(U\.S\.\s+Patent|Sheet\s+\d+\s+of\s+\d+|FIG\.?\s*\d+|cited by examiner|Foreign Application Priority Data|References Cited|Primary Examiner)"
FLOW_STEP = r"(?i)\bS\d{2,4}\b|\$[0-9]{2,4}|[-—]{2,}\s*\$?[0-9]{2,4}"
CLAIM_START = r"(?i)^\s*(?:\d+\.?\s*)?(?:A|An|The|That|In|Method|Device|System|Apparatus|Circuit|Memory|Non-transitory|One or more|What is claimed is|一种|一種|根据|如权利要求|基于|제\s*\d+\s*항|청구항|장치|방법|시스템|메모리|반도체)"
CLAIM_WORD = r"(?i)\b(comprising|wherein|configured|including|method|device|system|apparatus|circuit|memory|claim)\b|(包括|包含|其中|配置|方法|装置|系统|电路|存储器|权利要求|청구항|제\s*\d+\s*항|상기|있어서|포함|구비|방법|장치|시스템|회로|메모리)"
# The flags of a pack know four words more.
PACK_WORD = r"(?i)\b(comprising|wherein|configured|including|method|device|system|apparatus|circuit|memory|claim|medium|controller|processor|storage)\b|(包括|包含|其中|配置|方法|装置|系统|电路|存储器|权利要求|청구항|제\s*\d+\s*항|상기|있어서|포함|구비|방법|장치|시스템|회로|메모리)"
GIBBERISH = r"(?i)\b(?:Memary|Mernory|EONTRELLER|CENERATOR|Whas|Unesiacted|desver|Aysueg)\b"
NOISE = r"(?i)(onfrouler|g1iic|ceeee|wees|o\.\.|frorn|vaive|[A-Z]{2,}\d[A-Z]{2,})"
DEPENDENT = r"(?i)^\s*(?:the\s+.+?\s+of\s+claim\s+\d+|claim\s+\d+|제\s*\d+\s*항\s*에\s*있어서|청구항\s*\d+)"
TITLE_STOP = r"(?i)\s+(?:\(\d{2}\)|Applicant:|Applicants:|Inventors?:|Assignee:|Notice:|Appl\.?\s*No\.?:|Filed:|Prior Publication Data|Foreign Application Priority Data|Int\. Cl\.|U\.S\. Cl\.|Field of Classification|References Cited|Primary Examiner|Attorney, Agent, or Firm|\(57\)\s*ABSTRACT|ABSTRACT|U\.S\. Patent)"
TITLE_DIRT = r"(?i)(ABSTRACT|摘要|요약|权利要求|청구항|\(\s*(?:30|57|60|71|72|73|86)\s*\)|Applicant|Inventor|Assignee|Appl\.?\s*No\.?|Filed:|Prior Publication Data|Foreign Application Priority Data|Int\. Cl\.|U\.S\. Cl\.|References Cited|Primary Examiner|Attorney, Agent, or Firm|U\.S\. Patent)"
GENERIC = r"(?i)^(memory device|memory system|semiconductor device|storage device|method|system|device|non-volatile memory device|operation method|메모리 장치|메모리 시스템|반도체 장치|방법|시스템|장치|存储器装置|存储器系统|半导体装置|方法|系统|装置)$"
#: By country, in order: the first that matches gives the parent claim's number.
PARENTS = {
    "CN": (r"(?i)根据权利要求\s*(\d+)\s*所述", r"(?i)如权利要求\s*(\d+)\s*所述", r"(?i)权利要求\s*(\d+)\s*所述", r"(?i)(?:根据|如)权利要求\s*(\d+)\s*(?:至|-|~|到)\s*\d+\s*(?:任一项|中任一项)?", r"(?i)(?:根据|如)权利要求\s*(\d+)\s*(?:任一项|中任一项)", r"(?i)根据权利要求\s*([0-9]+)", r"(?i)如权利要求\s*([0-9]+)"),
    "KR": (r"(?i)청구항\s*(\d+)에\s*있어서", r"(?i)청구항\s*(\d+)"),
    "": (r"(?i)claim\s*(\d+)",),
}
#: Flags of an audited claim: weight, and weight where the text is a substantive claim.
WEIGHTS = {
    "very_short_claim_text": (25, 25), "figure_or_frontmatter_text": (45, 10), "flowchart_step_text": (20, 5), "ocr_gibberish_terms": (35, 35),
    "high_symbol_ratio": (30, 8), "low_letter_ratio": (30, 8), "diagram_line_art": (25, 8), "repeated_short_ocr_tokens": (20, 5),
    "independent_without_claim_keywords": (20, 20), "does_not_start_like_claim": (20, 20),
}
#: What a query that names a key also asks for.
ALIASES = {
    "메모리 평면": ("memory plane", "multiple memory planes", "multi_plane_architecture", "多个存储器平面"),
    "평면 주소": ("plane address", "no plane address", "no_plane_address_input", "不接收平面地址", "平面地址"),
    "plane address": ("plane address", "no plane address", "no_plane_address_input", "不接收平面地址", "平面地址"),
    "독립 명령": ("independent command", "command and address", "独立接收命令和地址", "independent command address"),
    "independent command": ("independent command", "command and address", "独立接收命令和地址", "independent command address"),
    "패드 그룹": ("pad group", "plane dedicated pad", "plane_dedicated_pad_group", "平面专用焊盘组"),
    "pad group": ("pad group", "plane dedicated pad", "plane_dedicated_pad_group", "平面专用焊盘组"),
    "데이터 경로": ("data path", "separate_data_path", "数据路径", "데이터 경로"),
    "페이지 버퍼": ("page buffer", "page_buffer_circuit", "页缓冲器", "페이지 버퍼"),
    "워드 라인": ("word line", "word_line_control", "字线", "워드 라인"),
    "비트 라인": ("bit line", "bit_line_connection", "位线", "비트 라인"),
    "읽기 전압": ("read voltage", "read_reference_voltage_control", "读取电压", "읽기 전압"),
    "garbage collection": ("garbage collection", "flash_garbage_collection", "垃圾回收"),
    "가비지 컬렉션": ("garbage collection", "flash_garbage_collection", "垃圾回收"),
    "ssd": ("SSD", "solid state drive", "solid_state_drive_data_operation", "固态硬盘"),
    "ssd accelerator": ("SSD accelerator", "accelerator", "token manager", "non-volatile memory array"),
    "펌웨어": ("firmware", "firmware_upgrade_control", "固件", "펌웨어"),
    "암호화": ("encryption", "decryption", "encryption_decryption_processing", "암호화"),
}
# Labels that are never given, labels that say little, and rules for labels that stand for missing ones.
DENIED = ("ect_data_labeling", "ect_data_labeling_platform", "composite_electrode_preparation")
LOW_VALUE = ("generic_memory_operation", "general_data_processing")
REPLACEMENTS = (
    ("memory_read_operation", r"读取|读操作|read operation|read command|read request|read data|판독|읽기"),
    ("memory_program_operation", r"编程|写入|program operation|programming|write operation|write data|프로그램|쓰기"),
    ("memory_erase_operation", r"擦除|erase operation|erase command|소거"),
    ("memory_control_operation", r"控制器|控制电路|控制逻辑|memory controller|control circuit|controller|제어기|제어 회로"),
    ("storage_device_management", r"存储装置|存储设备|存储系统|storage device|storage system|solid state drive|SSD|저장 장치"),
    ("semiconductor_memory_structure", r"半导体存储器|半导体装置|存储器结构|semiconductor memory|semiconductor device|memory structure|반도체 메모리"),
    ("flash_memory_operation", r"闪存|快闪|flash memory|NAND|NOR flash|플래시|낸드"),
    ("address_mapping_management", r"地址映射|逻辑地址|物理地址|address mapping|logical address|physical address|주소 매핑"),
    ("cache_management", r"缓存|cache|캐시"),
    ("firmware_update_control", r"固件|firmware|펌웨어"),
    ("data_analysis_model", r"数据分析|分析方法|模型|拟合|评估|data analysis|analysis model|fitting|evaluation|분석|모델|평가"),
    ("data_collection_control", r"数据采集|数据收集|采集模块|acquisition|data collection|collecting data|데이터 수집"),
    ("data_prediction_model", r"预测|预警|forecast|prediction|predictive|예측"),
    ("data_classification_recognition", r"分类|识别|辨识|classification|recognition|identify|인식|분류"),
    ("monitoring_signal_processing", r"监测|监控|信号处理|signal processing|monitoring|모니터링|신호 처리"),
    ("data_security_processing", r"加密|解密|认证|鉴权|encryption|decryption|authentication|security|암호화|복호화|인증"),
    ("image_data_processing", r"图像|影像|视觉|image|vision|이미지|영상"),
    ("communication_data_processing", r"通信|传输|总线|communication|transmission|bus|통신|전송|버스"),
    ("test_validation_control", r"测试|验证|校验|test|testing|validation|verify|검증|테스트"),
    ("power_quality_analysis", r"电能质量|power quality|전력 품질"),
)
# Where claims begin and end, by country, and how they are numbered.
CLAIM_CUE = {"KR": "청구범위", "US": r"(?i)what\s+is\s+claimed\s+is|the\s+invention\s+claimed\s+is|(?:^|\n)\s*(?:i|we)\s+claim\s*:?"}
DESCRIPTION_CUE = {"KR": "발명의 설명", "US": "Detailed Description"}
CLAIM_HEADER = r"(?i)what\s+is\s+claimed\s+is\s*:|the\s+invention\s+claimed\s+is\s*:|(?:^|\n)\s*(?:i|we)\s+claim\s*:?"
DRAWING_NOISE = r"(?i)(U\.S\.\s+Patent|Sheet\s+\d+\s+of\s+\d+|FIG\.?\s*\d+|cited by examiner)"
CLAIM_LINE = r"(?im)^\s*\d{1,3}\s*[.:]\s+(?:A\b|A[A-Za-z]|An\b|The\b|In\b).*(?:comprising|claim|wherein|configured|including)"
CLAIM_OPENING = r"(?:A\b|A[A-Za-z]|An\b|The\b|In\b)"
CANCELED = r"\(canceled\)|cancelled"
CANCELED_RANGE = r"(?im)^\s*\d{1,3}\s*-\s*\d{1,3}\s*[.:]\s*\(canceled\)"
CLAIM_SPLIT = {
    "KR": r"(?m)^\s*청구항\s*(\d+)\s*",
    "US": r"(?im)^\s*(\d{1,3})\s*[.:]\s*(?=(?:A\b|A[A-Za-z]|An\b|The\b|In\b)|\(canceled\)|cancelled)",
    "CN": r"(?m)(?:^|\n)\s*(\d{1,3})\s*[.．、]\s*(?=\S)",
    "": r"(?m)^\s*(\d+)\s*[.:]\s*",
}
REGION_START = (r"权\s*利\s*要\s*求\s*书", r"(?m)^\s*1\s*[.．、]\s*")
REGION_END = (r"说\s*明\s*书", r"技\s*术\s*领\s*域", r"发\s*明\s*内\s*容", r"附\s*图\s*说\s*明")
PAGE_ARTIFACTS = (r"(?m)^\h*权\s*利\s*要\s*求\s*书.*页\h*", r"(?m)^\h*说\s*明\s*书.*页\h*", r"(?im)^\h*CN\h*[A-Z]?\h*[\d\h]+[ABU]?\h*", r"(?m)^\h*\d+\h*")
CN_NUMBER = r"CN\s+(\d)\s+(\d)\s+(\d)\s+(\d)\s+(\d+)\s+([ABU])"
BLOCK_ARTIFACTS = (r"(?m)^\s*权\s*利\s*要\s*求\s*书.*$", r"(?im)^\s*CN\s*[A-Z]?\s*[\d\s]+[ABU]?\s*$", r"(?m)^\s*\d+\s*$")
# What refers to a part of a drawing, and what names a figure.
REFERENCE = r"\b(?:\d+[A-Za-z]+|[A-Za-z]{1,8}\d+[A-Za-z]*|W\d+|SGMC\d+|MS\d+|IF\d+|CS|DR|CR|FG|CG|SG|EG)\b"
CAPTION = r"(?i)图\s*(\d+)|FIG\.?\s*(\d+)|도\s*(\d+)"
DESCRIBED = r"^(图\s*\d+[^。；\n]*[。；]?)"
# Words by which a question names a country, in order, and the country's prefix of ids.
COUNTRY_WORDS = (("us", ("us", "미국")), ("cn", ("cn", "중국")), ("kr", ("kr", "한국")))
# Words of a question that say nothing.
STOP_TERMS = ("관련", "특허", "후보", "비교", "정리", "알려줘", "대해서", "기술", "patent", "candidate", "compare", "method", "device", "system")
