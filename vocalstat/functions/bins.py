"""Histogram bin edges.

FIXED VALUES: these edges must equal the published ones so that every
frequency array lines up with the viewer's labels. Listed in natural order.
"""

# fixed values: clip duration, seconds
DURATION = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 20, 30, 999999]
# fixed values: recordings per voice
VOICES = [0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192,
          16384, 32768, 65536, 131072, 999999]
# fixed values: recordings per sentence
SENTENCES = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 20, 30, 40, 50, 100, 999999]
# fixed values: words per sentence
WORDS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 16, 17, 18, 19,
         20, 21, 22, 23, 24, 25, 30, 40, 999999]
# fixed values: occurrences per token
TOKENS = [0, 1, 2, 4, 8, 16, 32, 64, 128, 256, 512, 1024, 2048, 4096, 8192,
          16384, 32768, 65536, 131072, 262144, 999999]
# fixed values: up votes and down votes per clip
VOTES_UP = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 999999]
VOTES_DOWN = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 999999]
# fixed values: reports per sentence
REPORTED = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 50, 100, 500, 1000, 999999]
# fixed values: characters per sentence; SHORT when the mean is below the threshold
CHARS_THRESHOLD = 30
CHARS_SHORT = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 15, 20, 25, 30, 35, 40, 45,
               50, 60, 70, 80, 999999]
CHARS_LONG = [0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100, 110, 120, 130, 140,
              150, 160, 170, 180, 190, 200, 250, 999999]
# fixed values: character speed (ms per character); LOW when the mean is below the threshold
CS_THRESHOLD = 300
CS_LOW = [0, 50, 60, 70, 80, 90, 100, 110, 120, 130, 140, 150, 175, 200, 250,
          300, 350, 400, 999999]
CS_HIGH = [0, 100, 200, 250, 300, 325, 350, 375, 400, 425, 450, 475, 500, 525,
           550, 575, 600, 650, 999999]
# fixed values: audio power (scaled), SNR (dB), percentage
POWER = [0, 1, 3, 10, 30, 100, 300, 1000, 3000, 10000, 30000, 100000, 999999]
SNR = [-9999999, -100, -30, -20, -10, 0, 10, 20, 30, 40, 50, 60, 70, 80, 90,
       100, 999999]
PERCENT = [0, 10, 20, 30, 40, 50, 60, 70, 80, 90, 100]


def trimmed_for_config() -> dict[str, list[int]]:
    """Bin lists as published in the configuration row.

    Lists whose first bin is dropped from the frequency arrays lose their
    first edge; every list but the percentages loses its open last edge.
    """
    return {
        "bins_percent": list(PERCENT),
        "bins_duration": DURATION[:-1],
        "bins_voices": VOICES[1:-1],
        "bins_votes_up": VOTES_UP[:-1],
        "bins_votes_down": VOTES_DOWN[:-1],
        "bins_sentences": SENTENCES[1:-1],
        "bins_cs_low": CS_LOW[:-1],
        "bins_cs_high": CS_HIGH[:-1],
        "bins_chars_short": CHARS_SHORT[:-1],
        "bins_chars_long": CHARS_LONG[:-1],
        "bins_words": WORDS[1:-1],
        "bins_tokens": TOKENS[1:-1],
        "bins_reported": REPORTED[1:-1],
        "bins_aa_pwr": POWER[:-1],
        "bins_aa_snr": SNR[1:-1],
    }
