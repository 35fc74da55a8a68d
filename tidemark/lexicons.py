"""Fixed values that results depend on: word lists, headings, thresholds, patterns."""

from __future__ import annotations

# Canonical headings and the wordings that stand for them.
HEADING_GROUPS: dict[str, tuple[str, ...]] = {
    "MD&A": ("Management Discussion and Analysis", "Management Discussion & Analysis", "Management Discussion", "Management Analysis", "MD&A", "MDA"),
    "Innovation": ("Innovation", "Innovation Strategy", "Innovation Initiatives", "Innovation and Technology", "Innovation & Technology", "Research Innovation"),
    "Digital Transformation": ("Digital Transformation", "Digital Strategy", "Digital Initiatives", "Digitalisation", "Digitisation", "Digitalization", "Digital Business"),
    "AI": ("Artificial Intelligence", "AI", "Generative AI", "Gen AI", "AI Initiatives", "AI and Analytics", "Artificial Intelligence Initiatives"),
    "Machine Learning": ("Machine Learning", "ML", "Deep Learning", "Predictive Models", "Predictive Analytics"),
    "Automation": ("Automation", "Process Automation", "Robotic Process Automation", "RPA", "Intelligent Automation"),
    "Technology": ("Technology", "Technology Initiatives", "Technology Strategy", "Information Technology", "Technology Transformation", "Technology and Innovation"),
    "Patents": ("Patents", "Patent", "Intellectual Property", "IPR", "IP Rights", "Intellectual Property Rights"),
    "Future Strategy": ("Future Strategy", "Business Outlook", "Future Outlook", "Strategic Priorities", "Corporate Strategy", "Outlook", "Strategy", "Future Plans", "Way Forward"),
    "Research & Development": ("Research & Development", "Research and Development", "R&D", "Research Development", "Research and Innovation", "Product Development"),
}
# Sections that a report is expected to have, in order.
EXPECTED_SECTIONS = ("MD&A", "Innovation", "Digital Transformation", "AI", "Machine Learning", "Automation", "Technology", "Patents", "Future Strategy", "Research & Development")
# Headings of reports that are known besides.
REPORT_HEADINGS = (
    "Board's Report", "Directors' Report", "Management Discussion and Analysis", "Business Responsibility and Sustainability Report", "Corporate Governance Report",
    "Integrated Report", "Strategy", "Risk Management", "Research and Development", "Technology", "Digital Transformation", "Innovation", "Human Resources", "Sustainability",
)
# The keyword dictionary where none is given.
KEYWORDS: dict[str, tuple[str, ...]] = {
    "artificial_intelligence": ("artificial intelligence", "ai", "machine learning", "deep learning", "generative ai", "natural language processing", "computer vision"),
    "automation": ("automation", "robotic process automation", "rpa", "intelligent automation", "process automation"),
    "analytics": ("data analytics", "advanced analytics", "big data", "predictive analytics", "data science", "business intelligence"),
    "digital_transformation": ("digital transformation", "digitalization", "digitisation", "cloud", "platform", "digital initiatives"),
    "innovation": ("innovation", "research and development", "r&d", "patent", "new product development", "technology adoption"),
}
# Acronyms whose casing is restored.
ACRONYMS = ("AI", "ML", "ESG", "R&D", "RPA", "NLP", "IoT", "API", "IT", "CSR", "BRSR", "CEO", "CFO", "COO", "CTO")
# Header names of the company master, squeezed to letters and digits.
MASTER_ALIASES: dict[str, tuple[str, ...]] = {
    "company_name": ("companyname", "company", "name"),
    "ticker": ("ticker", "symbol", "stocksymbol", "nseticker"),
    "industry": ("industry", "sector", "industryclassification"),
    "report_year": ("reportyear", "year", "financialyear", "fiscalyear"),
    "report_path": ("reportpath", "pdfpath", "filepath", "annualreport"),
    "source_url": ("sourceurl", "url", "reporturl", "downloadurl"),
}
# Characters and what they become.
SINGLE_QUOTES, DOUBLE_QUOTES = "‘’‚‛′‵", "“”„‟″‶"
HYPHENS, SOFT_HYPHEN, LONG_DASHES = "‐‑‒–−", "­", "—―"
BULLETS = "•●▪▫◦‣⁃"
# Characters that cleaning keeps besides letters, digits, marks and white space.
KEPT = r".,;:!?%&@(){}\[\]/\\+\-=*'\"`₹$€£#<>|^~–—"
# Patterns of lines.
PAGE_NUMBER = r"(?i)^\s*(?:page\s*)?(?:\d{1,4}|[ivxlcdm]{1,12})(?:\s*(?:of|/|-)\s*(?:\d{1,4}|[ivxlcdm]{1,12}))?\s*$"
TOC_TITLE = r"(?i)^\s*(?:table\s+of\s+contents|contents|index)\s*$"
TOC_ENTRY = r"^\s*.{2,120}?(?:\.{2,}|\s{2,})\s*\d{1,4}\s*$"
COMPANY_SUFFIX = r"(?i)\b(?:limited|ltd|private|pvt|plc|inc|corp|corporation|company|co\.?)\b\.?$"
NUMBER_PREFIX = r"(?i)^\s*(?:section|chapter|part)?\s*(?:[0-9]+(?:\.[0-9]+)*|[A-Z]|[IVXLCDM]+)?[\s.)-]*"
NUMBERED_HEADING = r"^\s*((?:\d+|[A-Z])(?:[.)]\d+)*[.)]?)\s+([A-Z][A-Za-z0-9&,\-/'() ]{2,120})\s*$"
PAGE_BREAK = r"(?i)\f|\n\s*[-–—]*\s*page\s+break\s*[-–—]*\s*\n"
PAGE_MARK = r"(?i)\n\s*(?:page\s+)?\d{1,4}\s*\n"
WORD = r"[\p{L}\p{N}]+(?:[&'-][\p{L}\p{N}]+)*"
# The score's weights, and the keyword density that counts as full.
WEIGHTS = {"keyword_density": 0.40, "category_coverage": 0.30, "section_coverage": 0.20, "keyword_diversity": 0.10}
DENSITY_BENCHMARK = 10.0
MIN_PRECISION, MIN_RECALL, HIGH = 0.75, 0.70, 0.90
