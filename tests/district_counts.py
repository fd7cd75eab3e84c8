"""Published case counts per district, and the known clusters."""

# The measures that vary; four more (campak_suspek, hiv_kasus_kumulatif, kusta, tetanus) are 0 throughout.
MEASURES = [
    "aids_kasus_baru",
    "aids_kasus_kumulatif",
    "dbd",
    "diare",
    "hiv_kasus_baru",
    "malaria_suspek",
    "pneumonia_balita",
    "tb_paru",
]
ZERO_MEASURES = ["campak_suspek", "hiv_kasus_kumulatif", "kusta", "tetanus"]

DISTRICTS = [
    ("A s a h a n", 34, 659, 55, 3422, 62, 2981, 0, 477),
    ("B i n j a i", 16, 16, 88, 779, 21, 19, 17, 1457),
    ("Batu Bara", 2, 2, 71, 4711, 35, 7510, 4, 451),
    ("D a i r i", 0, 0, 12, 4385, 30, 232, 6, 472),
    ("Deli Serdang", 27, 1492, 803, 33771, 144, 130, 1322, 2967),
    ("Gunungsitoli", 2, 2, 106, 440, 4, 80, 0, 76),
    ("Humbang Hasundutan", 0, 0, 0, 4340, 19, 128, 2, 319),
    ("K a r o", 2, 398, 15, 27450, 20, 299, 0, 426),
    ("Kota", 0, 0, 0, 0, 0, 0, 0, 0),
    ("L a n g k a t", 15, 16, 224, 12110, 16, 902, 202, 937),
    ("Labuhanbatu", 33, 93, 113, 4009, 0, 832, 0, 667),
    ("Labuhanbatu Selatan", 0, 0, 2, 3101, 0, 10, 0, 309),
    ("Labuhanbatu Utara", 16, 16, 30, 4659, 16, 661, 0, 420),
    ("M e d a n", 85, 1021, 652, 40126, 1200, 391, 81, 2697),
    ("Mandailing Natal", 0, 31, 6, 4143, 11, 1668, 1, 801),
    ("N i a s", 0, 13, 15, 162, 22, 215, 0, 33),
    ("Nias Barat", 0, 0, 5, 1328, 0, 200, 1, 58),
    ("Nias Selatan", 0, 0, 3, 966, 0, 46, 0, 117),
    ("Nias Utara", 0, 0, 3, 297, 0, 160, 0, 108),
    ("Padang Lawas", 6, 10, 12, 4553, 7, 55, 0, 366),
    ("Padang Lawas Utara", 4, 10, 103, 6059, 7, 9, 3, 414),
    ("Padangsidimpuan", 0, 0, 11, 789, 3, 0, 0, 344),
    ("Pakpak Bharat", 0, 0, 14, 1350, 1, 68, 0, 100),
    ("Pematangsiantar", 15, 189, 104, 293, 36, 28, 9, 636),
    ("S i b o l g a", 0, 4, 41, 344, 49, 179, 0, 338),
    ("Samosir", 6, 6, 21, 2800, 6, 110, 7, 179),
    ("Serdang Bedagai", 3, 12, 0, 4492, 28, 206, 4, 674),
    ("Simalungun", 34, 83, 177, 10316, 60, 0, 60, 1178),
    ("Tanjungbalai", 0, 0, 70, 6292, 38, 60, 0, 320),
    ("Tapanuli Selatan", 13, 26, 4, 5029, 26, 159, 1, 357),
    ("Tapanuli Tengah", 0, 0, 24, 2447, 38, 547, 24, 524),
    ("Tapanuli Utara", 7, 7, 11, 4481, 9, 6, 27, 398),
    ("Tebing Tinggi", 28, 96, 87, 1437, 44, 216, 87, 274),
    ("Toba", 56, 556, 41, 4274, 56, 254, 0, 253),
]

TOP_TEN = [
    ("M e d a n", 46253),
    ("Deli Serdang", 40656),
    ("K a r o", 28610),
    ("L a n g k a t", 14422),
    ("Batu Bara", 12786),
    ("Simalungun", 11908),
    ("A s a h a n", 7690),
    ("Tanjungbalai", 6780),
    ("Mandailing Natal", 6661),
    ("Padang Lawas Utara", 6609),
]

# Members of the smaller clusters at k = 4; all others form the largest.
SECOND_CLUSTER = ["A s a h a n", "Batu Bara", "K a r o", "L a n g k a t", "Labuhanbatu", "Simalungun", "Toba"]
SINGLE_CLUSTERS = ["Deli Serdang", "M e d a n"]

SILHOUETTE_BY_K = {2: 0.9086, 3: 0.8890, 4: 0.5803, 5: 0.4750, 6: 0.5855, 7: 0.5496, 8: 0.4905}
COST_BY_K = {2: 109.41, 3: 75.52, 4: 54.59, 5: 50.69, 6: 23.78, 7: 17.95, 8: 14.29}
