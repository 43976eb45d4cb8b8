"""Phrases and license wordings with their markup.

Markup: ``<<beginOptional>>`` … ``<<endOptional>>`` may be missing, blocks nest;
``<<var;name=…;words=a-b>>`` stands for a to b words of any kind;
``<<alt;one|two>>`` is one of these words. All other words are mandatory.
Only words count: case of A-Z, punctuation and line breaks do not.
"""

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

TEMPLATES = {
    "mit-notice": """<<alt;released|licensed|distributed|available|published>> under
        <<beginOptional>>the terms of<<endOptional>> <<beginOptional>>the<<endOptional>> MIT
        <<alt;license|licence>>""",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of
        <<var;name=software;words=1-10>> and associated documentation <<beginOptional>>files<<endOptional>>
        (the "<<var;name=name;words=1-3>>"), to deal in <<var;name=name;words=1-4>> without restriction, including
        without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
        copies of <<var;name=name;words=1-4>>, and to permit persons to whom <<var;name=name;words=1-4>> is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission
        notice <<beginOptional>>(including the next paragraph)<<endOptional>> shall be included in all copies or
        substantial portions of <<var;name=name;words=1-4>>.
        <<beginOptional>>THE <<var;name=name;words=1-3>> IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
        IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE
        AND NONINFRINGEMENT.<<endOptional>>""",
    "apache-2.0": """<<alt;licensed|released|distributed|available>> under
        <<beginOptional>>the terms of<<endOptional>> the Apache <<alt;license|licence>>
        <<beginOptional>>Version<<endOptional>> <<alt;2|v2>> <<beginOptional>>0<<endOptional>>""",
    "apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use
        <<var;name=file;words=1-4>> except in compliance with the License. You may obtain a copy of the License at
        <<beginOptional>>http <<beginOptional>>www<<endOptional>> apache org licenses
        LICENSE-2.0<<endOptional>> Unless required by applicable law or agreed to in writing, software distributed
        under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either
        express or implied. See the License for the specific language governing permissions and limitations under
        the License""",
    "gpl-3.0": """GNU <<alt;general|lesser>> <<beginOptional>>general<<endOptional>> public
        <<alt;license|licence>> <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> <<alt;version|v>> 3""",
    "gpl-2.0": """GNU <<alt;general|lesser>> <<beginOptional>>general<<endOptional>> public
        <<alt;license|licence>> <<beginOptional>>as published by the Free Software Foundation<<endOptional>>
        <<beginOptional>>either<<endOptional>> <<alt;version|v>> 2""",
    "gpl-notice": """is free software <<beginOptional>>you can redistribute it and/or modify it<<endOptional>>
        under the terms of <<var;name=license;words=4-6>> as published by the Free Software Foundation
        <<var;name=version;words=0-12>> any later version""",
    "cc-by-nc": """<<alt;licensed|released|available|published>> under
        <<beginOptional>>a<<endOptional>> <<beginOptional>>Creative Commons<<endOptional>> CC BY-NC
        <<beginOptional>><<alt;sa|nd>><<endOptional>> <<alt;1|2|3|4>> <<alt;0|5>>""",
    "cc-by-4.0": """Creative Commons Attribution <<beginOptional>><<alt;noncommercial|sharealike>><<endOptional>>
        4.0 International <<beginOptional>>Public<<endOptional>> License""",
    "bsd-clauses": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: <<beginOptional>>1<<endOptional>> Redistributions of source
        code must retain the above copyright notice, this list of conditions and the following disclaimer.
        <<beginOptional>>2<<endOptional>> Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided
        with the distribution. <<beginOptional>><<beginOptional>>3<<endOptional>> Neither the name of
        <<var;name=holder;words=1-12>> nor the names of <<var;name=contributors;words=1-6>> may be used to endorse
        or promote products derived from this software without specific prior written permission.<<endOptional>>""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee
        is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies""",
    "unlicense": """This is free and unencumbered software released into the public domain""",
}
