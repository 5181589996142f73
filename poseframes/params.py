"""Fixed values of the jobs: index layout, sampling, clustering, naming and playback."""

# --- fixed values: landmark layout and job parameters ---
TARGET_FPS = 10.0
DEFAULT_SRC_FPS = 25.0
MIN_VISIBILITY = 0.3
UPPER_BODY = [11, 12, 13, 14, 15, 16, 17, 18, 19, 20, 21, 22, 23, 24, 0]
N_BODY, N_HAND = 15, 21
N_POINTS = N_BODY + 2 * N_HAND
L_SHO, R_SHO, L_ELB, R_ELB, L_WRI, R_WRI = range(6)
L_HIP, R_HIP, NOSE = 12, 13, 14
L_HAND, R_HAND = 15, 36
EPS = 1e-6
VIDEO_EXTENSIONS = [".mp4", ".mov", ".avi", ".mkv", ".webm", ".mpg", ".mpeg", ".m4v"]
K_VALUES = [12, 18, 24, 30, 36, 42, 48, 54, 60]
STARTS, SWEEP_STARTS, SEED = 10, 3, 0
MAX_FRAMES_FOR_FIT, K_SAMPLE, SILHOUETTE_SAMPLE = 200_000, 8_000, 4_000
EDGE_FRAC = 0.12
TOP_SIGN_FRAMES, TOP_SIGNS = 20_000, 8
SMOOTH_WINDOW, MIN_SEGMENT_FRAMES = 3, 2
HANGING, TOGETHER_GAP = -1.8, 1.5
ZONES = [(-0.60, "WAIST"), (-0.10, "CHEST"), (0.50, "FACE")]
TOP_ZONE = "ABOVE_HEAD"
ABORT_AFTER_FAILURES = 8
HOLD = 0.7
HAND_SPREAD = 0.03
IDLE = "IDLE"
