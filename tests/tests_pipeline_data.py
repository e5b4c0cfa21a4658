"""CSV rows shared by the pipeline and streaming tests."""

HEADER = ("char_id,name,race,background,total_level,base_hp,stats_1,stats_2,stats_3,stats_4,stats_5,stats_6,"
          "notes_len,date_modified,class_starting,subclass_starting,class_starting_level,class_other,"
          "subclass_other,feats\n")
ROWS = [
    "7,Ann,Elf,Sage,5,30,10,12,14,8,20,9,120,2021-01-01,Wizard,Evocation,5,Fighter,Champion,Alert/Lucky",
    "7,Ann,Elf,Sage,6,31,10,12,14,8,20,9,130,2022-01-01,Wizard,Evocation,6,Fighter/Rogue,Champion,Alert",
    "8,Bob's character,Orc,Soldier,1,10,10,10,10,10,10,10,1,2022-01-01,Fighter,,1,,,",
    "9,Cid,Dwarf,Soldier,20,200,16,10,18,8,12,8,nan,2020-05-05,Cleric,Life,20,,,Tough",
]
