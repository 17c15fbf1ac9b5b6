"""Word lists, lookup tables, limits and patterns.

Results depend on these exact values, so they are data and not configuration.
"""

# --- fixed values: identity ---------------------------------------------------
DOCUMENT_NAMESPACE = "6f2c6b0a-3b0a-4c0e-9c1a-1f6a2b6f9d10"

# --- fixed values: interface labels that carry no content ---------------------
NOISE_LINES = [
    "home", "beranda", "menu", "navigation", "navigasi", "nav",
    "ornament", "ornamen", "oramen", "background ornament", "gambar latar",
    "profil", "profil kami", "tentang", "tentang kami", "tentang situs",
    "berita", "berita terkait", "artikel terkait", "baca juga",
    "informasi publik", "publikasi", "galeri", "layanan", "layanan publik",
    "tautan", "tautan cepat", "tautan terkait", "tautan luar",
    "kontak", "kontak kami", "hubungi kami", "contact us",
    "agenda", "pengumuman", "selengkapnya", "lihat semua", "lihat selengkapnya",
    "total pengunjung", "pengunjung", "jumlah pengunjung", "statistik pengunjung",
    "bulan ini", "hari ini", "minggu ini", "tahun ini",
    "share", "bagikan", "ikuti kami", "follow us", "media sosial", "social media",
    "iklan", "advertisement", "sponsored", "loading", "memuat", "mohon tunggu",
    "pencarian", "sitemap", "peta situs", "privacy policy", "kebijakan privasi",
    "syarat dan ketentuan", "skip to content", "lewati ke konten",
    "login", "masuk", "register", "banner", "sidebar", "breadcrumb",
    "terbaru", "populer", "terpopuler", "rekomendasi",
    "masukkan kata kunci", "masukkan kata kunci pencarian",
    "silahkan cari data", "silakan cari data",
]
NOISE_PREFIXES = [
    "©", "â©", "copyright", "hak cipta", "all rights reserved",
    "powered by", "didesain oleh", "designed by", "dikembangkan oleh",
    "developed by", "hosting by", "total pengunjung",
]
NAV_RESIDUE_CHARS = 20
LABEL_CHARS = 20
LABEL_WORDS = 3
NAV_RUN_MIN = 2

# --- fixed values: accented letters that count as parts of words --------------
WORD_LETTERS = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ"

# --- fixed values: titles that name a file kind or a button -------------------
GENERIC_TITLES = [
    "file", "files", "document", "documents", "dokumen", "berkas", "lampiran",
    "attachment", "attachments", "download", "downloads", "unduh", "unggah",
    "upload", "uploads", "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx",
    "csv", "zip", "rar", "image", "images", "gambar", "foto", "video", "audio",
    "true", "false", "null", "none", "ya", "tidak", "yes", "no",
    "untitled", "tanpa judul", "no title",
]
TITLE_KEYS = [
    "item", "title", "judul", "name", "nama", "label", "subject", "desc",
    "description", "keterangan",
]
SKIP_TITLE_KEYS = [
    "type", "kind", "jenis", "mode", "status", "state", "format", "ext", "extension",
    "mime", "mime_type", "content_type", "id", "uuid", "guid", "token", "slug", "hash",
    "checksum", "size", "ukuran", "bytes", "order", "sort", "sortir", "index", "indeks",
    "no", "nomor", "number", "page", "halaman", "step", "level", "depth", "parent",
    "required", "wajib", "loading", "selected", "active", "enabled", "verified",
    "path", "url", "uri", "link", "href", "file", "files", "filename", "file_name", "nama_file",
]

# --- fixed values: URLs and file kinds ----------------------------------------
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid", "yclid", "igshid", "mc_cid", "mc_eid", "_gl",
]
NON_PAGE_SCHEMES = "mailto|tel|javascript|data|blob|file|ftp|whatsapp"
TWO_LEVEL_SUFFIXES = ["co", "go", "ac", "or", "ne", "net", "sch", "mil", "gov", "com", "edu"]
DOCUMENT_EXTENSIONS = [
    "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "odt", "ods", "rtf", "csv",
]
DOCUMENT_MIME_EXTENSIONS = {
    "application/pdf": "pdf",
    "application/x-pdf": "pdf",
    "application/acrobat": "pdf",
    "application/msword": "doc",
    "application/vnd.openxmlformats-officedocument.wordprocessingml.document": "docx",
    "application/vnd.ms-excel": "xls",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "xlsx",
    "application/vnd.ms-powerpoint": "ppt",
    "application/vnd.openxmlformats-officedocument.presentationml.presentation": "pptx",
    "application/vnd.oasis.opendocument.text": "odt",
    "application/vnd.oasis.opendocument.spreadsheet": "ods",
    "application/rtf": "rtf",
    "text/rtf": "rtf",
    "text/csv": "csv",
    "application/csv": "csv",
}
DOWNLOAD_KEYWORDS = [
    "download", "unduh", "unduhan", "berkas", "lampiran", "attachment",
    "getfile", "get-file", "filedownload", "downloadfile", "download-file",
]
SKIP_LINK_EXTENSIONS = [
    "pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "odt", "ods",
    "zip", "rar", "7z", "gz", "tar", "apk", "exe", "iso",
    "jpg", "jpeg", "png", "gif", "bmp", "webp", "svg", "ico",
    "mp4", "mp3", "wav", "avi", "mov",
    "css", "js", "json", "xml", "rss", "woff", "woff2", "ttf", "eot",
]
ASSET_EXTENSIONS = [
    "js", "mjs", "cjs", "css", "map",
    "png", "jpg", "jpeg", "gif", "svg", "webp", "avif", "ico", "bmp",
    "woff", "woff2", "ttf", "otf", "eot",
    "mp4", "mp3", "wav", "ogg", "avi", "mov",
    "zip", "rar", "7z", "gz", "tar", "apk", "exe",
]
TRACKER_PATH_KEYWORDS = [
    "analytics", "visitor", "track", "statistic", "metrics", "heartbeat", "ping",
    "newsletter", "subscribe", "notification", "report-to", "csp-report",
    "login", "logout", "auth", "token", "session", "captcha", "csrf",
    "contact", "survey", "questionnaire", "sentiment", "comment", "rating",
    "edit", "delete", "create", "update", "store", "upload", "import", "export",
    "cart", "checkout", "payment", "unsubscribe",
]
EMBEDDED_SOURCES = [("object", "data"), ("embed", "src"), ("iframe", "src"), ("source", "src")]
DEFAULT_ROBOTS_TOKEN = "docloom"

# --- fixed values: HTML -------------------------------------------------------
DROP_TAGS = [
    "script", "style", "noscript", "svg", "canvas", "iframe", "template",
    "form", "button", "input", "select", "textarea", "option",
]
NAVIGATION_TAGS = ["nav", "footer", "aside", "dialog", "menu"]
BLOCK_TAGS = [
    "p", "div", "section", "article", "main", "header", "footer", "aside",
    "figure", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6",
    "ul", "ol", "li", "dl", "dt", "dd", "blockquote", "pre", "table",
    "thead", "tbody", "tr", "hr", "address", "details", "summary",
]
VOID_TAGS = [
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta",
    "param", "source", "track", "wbr",
]
NOISE_ATTRIBUTE = (
    "(^|[^a-z])(cookie|banner|sidebar|navbar|breadcrumb|social|share|advert|ads|popup|"
    "modal|subscribe|newsletter)([^a-z]|$)"
)
NOISE_ELEMENT_CHARS = 200
ROOT_MIN_CHARS = 400
ROOT_SHARE = 0.6
SKELETON_MIN_TEXT = 2000
SKELETON_MAX_RATIO = 0.03
SCRIPT_MESSAGE = (
    "enable\\s+JavaScript|aktifkan\\s+JavaScript|JavaScript\\s+(?:harus|perlu|wajib)|"
    "requires?\\s+JavaScript"
)

# --- fixed values: limits and defaults ----------------------------------------
CHUNK_SIZE = 12000
CHUNK_OVERLAP = 1200
MIN_CHUNK_LENGTH = 50
MAX_LINK_RATIO = 0.6
BATCH_MAX_CHUNKS = 8
BATCH_MAX_CHARS = 40000
UPSERT_BATCH = 64
EXPORT_MAX_POINTS = 10000
FINGERPRINT_TOKENS = 600
FINGERPRINT_HISTORY = 300
DUPLICATE_SIMILARITY = 0.85
RUN_ACTIVE_SECONDS = 180
ESTIMATE_DEFAULTS = {
    "detik_unduh": 2.5,
    "detik_parse": 12.0,
    "detik_vektor": 1.2,
    "detik_render": 6.0,
    "vektor_per_url": 6.0,
    "dokumen_per_url": 0.3,
    "porsi_render": 0.2,
    "halaman_per_run": 100.0,
}
SITE_STATUSES = ["success", "failed_akses", "discovered"]
ACTIVE_JOB_STATUSES = ["MENUNGGU", "BERJALAN", "DIJEDA"]
TRANSIENT_HTTP = [429, 500, 502, 503, 504]

# --- fixed values: script skeleton markers, discovery prefixes, metrics ---------
SKELETON_MARKERS = [
    "self.__next_f", "__NEXT_DATA__", 'id="__next"', "__NUXT__", 'id="__nuxt"',
    "data-reactroot", 'id="root"', 'id="app"', "ng-version", "data-server-rendered",
    'id="___gatsby"',
]
DISCOVERY_PREFIXES = [
    "www", "ppid", "jdih", "opendata", "data", "sip", "setjen", "itjen",
    "satudata", "satu-data", "sakip", "e-sakip", "e-learning", "portal",
    "layanan", "informasi", "berita", "media", "api", "backend", "otda",
    "polpum", "bangda", "bina-adwil", "bina-pemdes", "itbang", "pusdiklat",
]
DISTANCES = ["Cosine", "Euclid", "Dot", "Manhattan"]
UPLOAD_MIME = {
    "pdf": "application/pdf",
    "doc": "application/msword",
    "docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    "xls": "application/vnd.ms-excel",
    "xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    "ppt": "application/vnd.ms-powerpoint",
    "pptx": "application/vnd.openxmlformats-officedocument.presentationml.presentation",
    "odt": "application/vnd.oasis.opendocument.text",
    "ods": "application/vnd.oasis.opendocument.spreadsheet",
    "rtf": "application/rtf",
    "csv": "text/csv",
    "txt": "text/plain",
}
DEFAULT_UPLOAD_MIME = "text/html"
